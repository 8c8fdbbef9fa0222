"""Tables replaced as a whole: old version until the new one is checked."""

from __future__ import annotations

import pytest

from lakeops.operators.quality import assert_unique, require_non_empty
from lakeops.sources.layers import Lake
from lakeops.sources.published import publish, read_published, versions
from lakeops.workspace import new_folder

SCHEMA = "id int, team string"


def _check(df):
    return assert_unique(require_non_empty(df, "mart"), ["id"])


def test_a_failed_refresh_changes_nothing(spark, rows):
    path = new_folder(spark, "mart")
    old, new = [(1, "a"), (2, "b")], [(1, "c"), (3, None)]
    assert publish(spark.createDataFrame(old, SCHEMA), path, check=_check, partition_by=["team"]) == 1
    kept = read_published(spark, path)
    for bad in ([], [(1, "a"), (1, "b")]):
        with pytest.raises(ValueError):
            publish(spark.createDataFrame(bad, SCHEMA), path, check=_check, partition_by=["team"])
        assert rows(read_published(spark, path)) == old
    assert publish(spark.createDataFrame(new, SCHEMA), path, check=_check, partition_by=["team"]) == 2
    assert rows(read_published(spark, path), "id", "team") == new
    assert rows(kept) == old  # a frame made before reads its own version
    assert [r.version for r in versions(spark, path).collect()] == [2, 1]


def test_a_refresh_that_breaks_while_writing(spark, rows):
    path = new_folder(spark, "mart")
    publish(spark.createDataFrame([(1, "a")], SCHEMA), path)
    broken = spark.range(3).selectExpr("cast(id as int) id", "raise_error('stopped') team")
    with pytest.raises(Exception, match="stopped"):
        publish(broken, path)
    assert rows(read_published(spark, path)) == [(1, "a")]


def test_a_refresh_may_read_its_own_table(spark, rows):
    path = new_folder(spark, "mart")
    publish(spark.createDataFrame([(1, "a")], SCHEMA), path)
    publish(read_published(spark, path).selectExpr("id + 1 id", "team"), path)
    assert rows(read_published(spark, path)) == [(2, "a")]


def test_marts_of_the_lake(spark, rows):
    lake = Lake(new_folder(spark, "lake"))
    path = lake.path("warehouse", "mart")
    frame = spark.createDataFrame([(1, "a")], SCHEMA)
    frame.limit(0).write.parquet(path)  # created empty, nothing published
    assert rows(lake.read(spark, "warehouse", "mart", frame.schema)) == []
    publish(frame, path)
    assert rows(lake.read(spark, "warehouse", "mart")) == [(1, "a")]
    assert rows(spark.read.schema(frame.schema).parquet(path)) == []
