"""Merges: matched, inserted, NULL keys and values, moving rows, repeated runs."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from lakeops.operators.merge import _in_partitions, replace_rows, update_matched, upsert, upsert_table
from lakeops.sources.files import ensure_table, write_table
from lakeops.workspace import new_folder

COLUMNS = "id int, v string, month date"
JAN, FEB, MAR = (dt.date(2024, m, 1) for m in (1, 2, 3))


@pytest.fixture
def target(spark):
    return spark.createDataFrame([(1, "a", JAN), (2, "b", JAN), (3, "c", FEB), (None, "n", JAN)], COLUMNS)


def test_upsert(spark, target, rows):
    source = spark.createDataFrame([(1, None, JAN), (4, "d", MAR), (None, "m", JAN)], COLUMNS)
    assert rows(upsert(target, source, ["id"]), "id", "v") == [
        (None, "m"), (None, "n"), (1, None), (2, "b"), (3, "c"), (4, "d"),
    ]
    assert rows(upsert(target, source, ["id"], insert=False), "id", "v") == [
        (None, "n"), (1, None), (2, "b"), (3, "c"),
    ]


def test_upsert_fewer_columns(spark, target, rows):
    source = spark.createDataFrame([(1, "z"), (9, "y")], "id int, v string")
    assert rows(upsert(target, source, ["id"]).where("id in (1, 9)")) == [(1, "z", JAN), (9, "y", None)]


def test_older_rows_do_not_replace_newer(spark, rows):
    state = spark.createDataFrame([(1, 5, "new"), (2, 5, "old")], "id int, at int, v string")
    feed = spark.createDataFrame([(1, 4, "late"), (2, 6, "newer")], "id int, at int, v string")
    assert rows(upsert(state, feed, ["id"], newer_by="at")) == [(1, 5, "new"), (2, 6, "newer")]


def test_replace_rows_equals_upsert(spark, target, rows):
    source = spark.createDataFrame([(1, None, JAN), (4, "d", MAR), (None, "m", JAN), (2, "z", None)], COLUMNS)
    assert rows(replace_rows(target, source, ["id"])) == rows(upsert(target, source, ["id"]))
    for newer in ("month", "v"):
        got = replace_rows(target, source, ["id"], newer)
        assert rows(got) == rows(upsert(target, source, ["id"], newer_by=newer))


def test_repeat_repairs_a_merge_that_stopped(spark, target, rows):
    """The new partition was written, the old one not yet: the key is there twice."""
    path = new_folder(spark, "t")
    half = target.unionAll(spark.createDataFrame([(1, "a2", MAR)], COLUMNS))
    write_table(half, path, partition_by=["month"])
    source = spark.createDataFrame([(1, "a2", MAR)], COLUMNS)
    upsert_table(spark, path, target.schema, source, ["id"], "month")
    stored = spark.read.schema(target.schema).parquet(path)
    assert rows(stored.where("id = 1"), "id", "v", "month") == [(1, "a2", MAR)]
    assert stored.count() == 4


def test_upsert_table(spark, target, rows):
    path = new_folder(spark, "t")
    write_table(target, path, partition_by=["month"])
    # 3 moves from February, which is then empty; 4 is new
    source = spark.createDataFrame([(3, "c2", MAR), (4, "d", MAR)], COLUMNS)
    args = (spark, path, target.schema, source, ["id"], "month")
    assert upsert_table(*args) == [FEB, MAR]
    want = [(None, "n", JAN), (1, "a", JAN), (2, "b", JAN), (3, "c2", MAR), (4, "d", MAR)]
    read = lambda: rows(spark.read.schema(target.schema).parquet(path).select("id", "v", "month"))
    assert read() == want
    upsert_table(*args)
    assert read() == want


def test_untouched_partitions_keep_their_files(spark, target):
    path = new_folder(spark, "t")
    write_table(target, path, partition_by=["month"])
    files = lambda: {f for f in spark.read.parquet(path).inputFiles() if "2024-01" in f}
    before = files()
    upsert_table(
        spark, path, target.schema, spark.createDataFrame([(3, "x", FEB)], COLUMNS), ["id"], "month"
    )
    assert files() == before


def test_duplicate_source_key_is_an_error(spark, target):
    path = new_folder(spark, "t")
    ensure_table(spark, path, target.schema, ["month"])
    twice = spark.createDataFrame([(1, "a", JAN), (1, "b", JAN)], COLUMNS)
    with pytest.raises(ValueError, match="not unique"):
        upsert_table(spark, path, target.schema, twice, ["id"], "month")


def test_update_matched_ignores_case(spark, rows):
    state = spark.createDataFrame([("Ana", "Bo", 1.0), ("Cy", "Di", 2.0)], "fn string, ln string, x double")
    feed = spark.createDataFrame([("ANA", "bo", None), ("No", "Body", 9.0)], "f string, l string, y double")
    got = update_matched(state, feed, {"fn": "f", "ln": "l"}, {"x": "y"})
    assert rows(got) == [("Ana", "Bo", None), ("Cy", "Di", 2.0)]
    exact = update_matched(state, feed, {"fn": "f", "ln": "l"}, {"x": "y"}, ignore_case=False)
    assert rows(exact) == [("Ana", "Bo", 1.0), ("Cy", "Di", 2.0)]


def test_small_source_does_not_shuffle_the_target(spark, tables):
    state = tables.read("lineitem")
    feed = state.limit(3)
    plan = upsert(state, feed, ["l_orderkey"], insert=False)._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan


def test_equal_times_are_ordered_by_the_next_column(spark, rows):
    schema = "id int, at int, event int"
    target = spark.createDataFrame([(1, 5, 5), (2, 5, 1)], schema)
    source = spark.createDataFrame([(1, 5, 3), (2, 5, 3), (3, None, 1)], schema)
    for merge in (upsert, replace_rows):
        got = merge(target, source, ["id"], newer_by=["at", "event"])
        assert rows(got) == [(1, 5, 5), (2, 5, 3), (3, None, 1)]


@pytest.mark.parametrize("kind, old, new", [
    ("string", "a:b", "c d/e%"),
    ("timestamp_ntz", dt.datetime(2024, 1, 1, 10, 30), dt.datetime(2024, 1, 2)),
])
def test_emptied_partitions_with_special_characters(spark, rows, kind, old, new):
    schema = T.StructType.fromDDL(f"id int, part {kind}, value int")
    path = new_folder(spark, "t")
    write_table(spark.createDataFrame([(1, old, 1), (2, new, 2)], schema), path, partition_by=["part"])
    source = spark.createDataFrame([(1, new, 3)], schema)
    upsert_table(spark, path, schema, source, ["id"], "part", sort_by=["id"])
    assert rows(spark.read.schema(schema).parquet(path), "id", "value") == [(1, 3), (2, 2)]


def test_touched_partitions_are_a_joined_table(spark, rows):
    """Of 300 partitions the merge reads 120, NULL among them, by pruning at run time."""
    schema = T.StructType.fromDDL("id int, value int, part int")
    path = new_folder(spark, "t")
    spark.range(300).selectExpr("cast(id as int) id", "0 value", "cast(if(id = 0, null, id) as int) part").repartition(
        1
    ).write.partitionBy("part").parquet(path)
    source = spark.range(120).selectExpr("cast(id as int) id", "1 value", "cast(if(id = 0, null, id) as int) part")
    assert len(upsert_table(spark, path, schema, source, ["id"], "part")) == 120
    stored = spark.read.schema(schema).parquet(path)
    assert rows(stored, "id", "value") == [(i, int(i < 120)) for i in range(300)]

    touched = source.groupBy("part").count().withColumnRenamed("count", "_rows")
    found = _in_partitions(stored, touched.where("part is not null"), "part")
    assert found.count() == 119
    assert "dynamicpruning" in found._jdf.queryExecution().executedPlan().toString()
