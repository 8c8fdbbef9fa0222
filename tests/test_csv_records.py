"""CSV with line breaks inside text, read by many tasks."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.sources.files import csv_records, read_csv, read_csv_lenient, read_csv_records, write_table
from lakeops.workspace import new_folder

SCHEMA = "id int, a string, b string"
TEXTS = [
    None, "", "\u0001", "plain", "two\nlines", '"', '""', 'a "b"\n"c"', "\n", "\n\n\nlate", "x,y", "\\", "\\\n\"",
    " around ", "line\n\"\n\"\n" * 5, "long\n" * 200,
]


@pytest.fixture
def small_blocks(spark):
    names = {"spark.sql.files.maxPartitionBytes": "300", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _frame(spark, copies=3):
    data = [(i, t, TEXTS[(i * 7) % len(TEXTS)]) for i, t in enumerate(TEXTS * copies)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("files", [1, 3])
def test_equals_the_reader_by_file(spark, rows, small_blocks, files):
    path, frame = new_folder(spark, "csv"), _frame(spark)
    write_table(frame.repartition(files), path, fmt="csv")
    assert spark.read.text(path).rdd.getNumPartitions() > 5 * files
    want = rows(frame)
    assert rows(read_csv_records(spark, path, frame.schema)) == want
    assert rows(read_csv(spark, path, frame.schema, line_breaks=True)) == want


def test_blocks_without_a_record_start(spark, rows, small_blocks):
    path = new_folder(spark, "csv")
    frame = spark.createDataFrame([(1, "first", "x"), (2, "y\n" * 2000, "z"), (3, "", None)], SCHEMA)
    write_table(frame.coalesce(1), path, fmt="csv")
    assert rows(read_csv_records(spark, path, frame.schema)) == rows(frame)


def test_windows_line_ends_blank_lines_and_headers(spark, rows, tmp_path):
    (tmp_path / "a.csv").write_bytes(b'id,"a\nname",b\r\n1,"x\r\ny",\r\n\r\n2,,""\r\n')
    (tmp_path / "b.csv").write_bytes(b"id,a,b\n3,p,q")
    (tmp_path / "c.csv").write_bytes(b"id,a,b\n")
    got = read_csv_records(spark, str(tmp_path), spark.createDataFrame([], SCHEMA).schema)
    assert rows(got) == [(1, "x\r\ny", None), (2, None, ""), (3, "p", "q")]
    assert csv_records(spark, str(tmp_path)).count() == 3


def test_lenient_reader_keeps_empty_text(spark, rows):
    path, frame = new_folder(spark, "csv"), spark.createDataFrame([(1, "", None), (2, "\u0001", "x")], SCHEMA)
    write_table(frame, path, fmt="csv")
    assert rows(read_csv_lenient(spark, path, frame.schema)) == rows(frame)
    assert rows(read_csv(spark, path, frame.schema).where(F.col("a") == "\u0001"), "id") == [(2,)]
