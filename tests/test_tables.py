"""Files, versions, quality, increments and reports on small frames."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators import aggregates, history, incremental, joins, quality
from lakeops.sources import files, streams
from lakeops.workspace import new_folder, shared_folder


def test_workspace_is_the_shared_folder(spark):
    assert shared_folder(spark) == spark.conf.get("spark.checkpoint.dir")
    assert new_folder(spark, "a") != new_folder(spark, "a")


def test_csv(spark, rows):
    path = new_folder(spark, "csv")
    schema = T.StructType().add("i", "integer").add("s", "string").add("d", "double")
    df = spark.createDataFrame([(1, "a,b", 1.5), (2, None, None)], schema)
    files.write_table(df, path, fmt="csv")
    assert rows(files.read_csv(spark, path, schema)) == rows(df) == rows(files.read_csv(spark, path))
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        files.write_table(df, path, fmt="csv")


def test_merged_schemas(spark, rows):
    path = new_folder(spark, "t")
    spark.createDataFrame([(1,)], "a int").write.parquet(f"{path}/x=1")
    spark.createDataFrame([(2, "b")], "a int, b string").write.parquet(f"{path}/x=2")
    assert rows(files.read_parquet_merged(spark, path), "a", "b") == [(1, None), (2, "b")]


def test_periods(spark, rows):
    path = new_folder(spark, "t")
    schema = "v int, year int, month int"
    files.write_table(
        spark.createDataFrame([(1, 2018, 3), (2, 2018, 12)], schema), path, partition_by=["year", "month"]
    )
    table = spark.read.parquet(path)
    assert rows(files.read_period(table, 2018, 3)) == [(1, 2018, 3)]
    assert files.read_period(table, 2019, 1).isEmpty()
    assert [tuple(r) for r in files.available_periods(table).collect()] == [(2018, 3), (2018, 12)]
    plan = files.read_period(table, 2018, 3)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(year" in plan
    # a month loaded again is replaced, the other stays
    files.write_table(
        spark.createDataFrame([(9, 2018, 3)], schema), path,
        mode="overwrite", partition_by=["year", "month"], dynamic=True,
    )
    assert rows(spark.read.parquet(path), "v") == [(2,), (9,)]


def test_sorted_files_are_disjoint(spark):
    path = new_folder(spark, "t")
    df = spark.range(10000).select((F.col("id") * 7919 % 10000).alias("v"))
    files.write_sorted(df.repartition(4), path, ["v"])
    bounds = (
        spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("f"))
        .agg(F.min("v").alias("low"), F.max("v").alias("high")).orderBy("low").collect()
    )
    assert all(a.high < b.low for a, b in zip(bounds, bounds[1:]))


def test_single_file(spark):
    path = new_folder(spark, "t")
    files.write_single_file(spark.range(100).repartition(3), path)
    assert len(spark.read.parquet(path).inputFiles()) == 1
    assert spark.read.parquet(path).count() == 100


def test_csv_keeps_any_text(spark, rows):
    path = new_folder(spark, "t")
    texts = ["a\nb", 'say "x", \\n', "back\\", "", None, "plain", '"', "\n", "a,b"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    files.write_table(df, path, fmt="csv")
    assert rows(files.read_csv(spark, path, df.schema, line_breaks=True)) == rows(df)


def test_drop_table_and_write_options(spark):
    spark.range(3).write.mode("overwrite").saveAsTable("gone")
    files.drop_table(spark, "gone")
    files.drop_table(spark, "gone")
    assert not spark.catalog.tableExists("gone")
    path = new_folder(spark, "t")
    files.write_table(spark.range(3), path, options={"compression": "gzip"})
    assert all(".gz." in f for f in spark.read.parquet(path).inputFiles())


def test_ensure_table_keeps_rows(spark):
    path, schema = new_folder(spark, "t"), T.StructType().add("a", "integer")
    files.ensure_table(spark, path, schema)
    assert spark.read.parquet(path).schema == schema
    files.write_table(spark.createDataFrame([(1,)], schema), path, mode="append")
    files.ensure_table(spark, path, schema)
    assert spark.read.parquet(path).count() == 1


def test_storage_size(spark):
    path = new_folder(spark, "t")
    spark.range(10).repartition(2).write.parquet(path)
    sizes = files.storage_size(spark, {"t": path}).first()
    parquet = files.file_sizes(spark, path, ".parquet")
    assert parquet.count() == 2 and sizes["bytes"] >= parquet.agg(F.sum("length")).first()[0]


@pytest.fixture
def versions(spark):
    table = history.VersionedTable(spark, new_folder(spark, "versions"), ("id",))
    at = "2026-03-20 18:18:00"
    table.commit(spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string"), 1, at)
    table.commit(spark.createDataFrame([(2, None, 5)], "id int, v string, extra int"), 2, at)
    table.commit(spark.createDataFrame([(1,)], "id int"), 3, at, history.DELETE)
    table.commit(spark.createDataFrame([], "id int, v string"), 4, at)
    return table


def test_versions(spark, versions, rows):
    assert rows(versions.as_of(1), "id", "v") == [(1, "a"), (2, "b")]
    assert rows(versions.as_of(2), "id", "v", "extra") == [(1, "a", None), (2, None, 5)]
    assert rows(versions.latest(), "id") == [(2,)] == rows(versions.as_of(4), "id")
    assert [tuple(r)[0::2] + (r.changed_rows,) for r in versions.log().collect()] == [
        (4, "upsert", 0), (3, "delete", 1), (2, "upsert", 1), (1, "upsert", 2),
    ]
    # a repeated commit replaces its version
    versions.commit(spark.createDataFrame([(1,)], "id int"), 3, "2026-03-20 18:18:00", history.DELETE)
    assert versions.changes().where("_version = 3").count() == 1
    small = versions.compact(new_folder(spark, "compact"), 2, "2026-03-21 00:00:00")
    assert rows(small.latest(), "id", "v") == rows(versions.as_of(2), "id", "v")


def test_schema_changes(spark, rows):
    old = spark.createDataFrame([(1, "a", 2)], "id int, name string, gone int")
    new = history.drop_columns(history.add_columns(old, {"salary": "double"}), ["gone", "never"])
    new = new.withColumn("id", F.col("id").cast("bigint"))
    assert {tuple(r) for r in history.schema_diff(old, new).collect()} == {
        ("id", "int", "bigint", "changed"), ("name", "string", "string", "same"),
        ("gone", "int", None, "dropped"), ("salary", None, "double", "added"),
    }
    assert rows(history.union_evolved(old, new), "salary") == [(None,), (None,)]
    assert rows(history.filled_counts(new, "n")) == [("id", 1), ("name", 1), ("salary", 0)]
    assert rows(history.describe(old)) == [("gone", "int"), ("id", "int"), ("name", "string")]


def test_quality(spark):
    df = spark.createDataFrame([(1, 5.0), (1, 0.0), (None, None)], "id int, price double")
    got = {r.check_name: tuple(r)[1:] for r in quality.quality_report(df, "id", "price", ["id"]).collect()}
    assert got == {
        "duplicates": (3, 1, "FAIL"), "positive_price": (3, 1, "FAIL"), "null_id": (0, 1, "FAIL"),
    }
    empty = quality.quality_report(df.limit(0), "id", "price", ["id"])
    assert {r.status for r in empty.collect()} == {"PASS"}
    with pytest.raises(ValueError):
        quality.require_non_empty(df.limit(0))
    with pytest.raises(ValueError, match="not unique"):
        quality.assert_unique(df, ["id"])
    assert quality.assert_unique(df, ["id", "price"]) is df


def test_null_profile(spark, rows):
    df = spark.createDataFrame([(1, None), (None, None), (3, 1)], "d int, o int")
    both = F.col("d").isNull() & F.col("o").isNull()
    got = quality.null_profile(df, {"o": F.col("o").isNull(), "both": both})
    assert rows(got) == [("both", 1, 33.33), ("o", 2, 66.67)]
    assert rows(quality.null_profile(df.limit(0), {"both": both})) == [("both", 0, None)]


def test_increments(spark, rows):
    at = lambda d: dt.datetime(2025, 10, d)
    feed = spark.createDataFrame([(i, at(d)) for i, d in enumerate([20, 21, 22, 19])], "i int, ts timestamp_ntz")
    # an empty target starts at the default mark, which is itself not loaded again
    got = incremental.incremental_rows(feed, feed.limit(0), "ts", ["i"])
    assert [r.i for r in got.collect()] == [1, 2]
    assert rows(incremental.incremental_rows(feed, feed.where("i = 1"), "ts", ["i"]), "i") == [(2,)]
    days = incremental.missing_days(feed.where("i <> 1"), "ts", feed.selectExpr("ts + interval 2 days as u"), "u")
    assert [str(r.day) for r in days.collect()] == ["2025-10-21", "2025-10-23", "2025-10-24"]
    assert incremental.missing_days(feed.limit(0), "ts", feed, "ts").isEmpty()


def test_joins(spark, rows):
    box = spark.createDataFrame([(1, 10), (2, 20)], "person bigint, game bigint")
    adv = spark.createDataFrame([(1, "10", 0.5), (2, "x", 0.7)], "person int, game string, pie double")
    assert rows(joins.typed_key_join(box, adv, {"person": "bigint", "game": "bigint"})) == [(1, 10, 0.5)]
    score = spark.createDataFrame([(1, "3 - 2")], "game int, score string")
    shots = spark.createDataFrame([(1,), (2,)], "game int")
    assert rows(joins.lookup(shots, score, ["game"], "score", "0 - 0")) == [(1, "3 - 2"), (2, "0 - 0")]


def test_reports(spark, rows):
    df = spark.createDataFrame(
        [("q1", "x", 10.0, 2), ("q1", "x", 20.0, 1), ("q1", "y", 5.0, 3), (None, "x", 1.0, 4)],
        "q string, engine string, ms double, at int",
    )
    assert rows(aggregates.run_stats(df, ["q", "engine"], "ms")) == [
        (None, "x", 1, 1.0, 1.0, 1.0, 0.0), ("q1", "x", 2, 15.0, 10.0, 20.0, 7.07), ("q1", "y", 1, 5.0, 5.0, 5.0, 0.0),
    ]
    assert rows(aggregates.pivot_first(df, ["q"], "engine", "ms", "at")) == [(None, 1.0, None), ("q1", 20.0, 5.0)]
    assert rows(aggregates.pivot_mean(df, ["q"], "engine", "ms", values=["x", "y"])) == [(None, 1.0, None), ("q1", 15.0, 5.0)]
    means = aggregates.group_averages(df, ["q"], {"avg_sum": F.col("at") + F.nullif(F.col("at"), F.lit(2))}, "n")
    # a sum with a NULL part is left out of the mean, not out of the count
    assert rows(means) == [(None, 1, 8.0), ("q1", 3, 4.0)]
    assert rows(aggregates.row_counts({"a": df, "b": df.limit(1)})) == [("TOTAL", 5), ("a", 4), ("b", 1)]
    wide = spark.createDataFrame([("n", 5.0, None, -1.0)], "name string, a double, b double, c double")
    long = aggregates.unpivot_positive(wide, ["name"], {"a": "2025-26", "b": "2026-27", "c": "2027-28"}, "season", "usd")
    assert rows(long) == [("n", "2025-26", 5.0)]


def test_topic_options():
    assert streams.broker_options("broker:9092", "games", "latest") == {
        "kafka.bootstrap.servers": "broker:9092", "subscribe": "games", "startingOffsets": "latest",
    }
    with pytest.raises(ValueError):
        streams.broker_options("broker:9092", "games", "middle")


def test_large_partition_is_written_by_several_tasks(spark):
    path = new_folder(spark, "t")
    name = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, "100k")
    try:
        df = spark.range(0, 200_000, 1, 6).select(
            F.when(F.col("id") % 3 == 0, F.col("id") % 50).otherwise(99).alias("month"), F.xxhash64("id").alias("v")
        )
        files.write_table(df, path, partition_by=["month"], sort_by=["v"])
    finally:
        spark.conf.set(name, before)
    per_month = {}
    for f in spark.read.parquet(path).inputFiles():
        month = f.split("month=")[1].split("/")[0]
        per_month[month] = per_month.get(month, 0) + 1
    assert len(per_month) == 51 and per_month["99"] > 3
    # months that share a shuffle partition with the large one are split with it
    assert sum(per_month.values()) < 6 * 51


def test_fixed_partition_reads_only_its_buckets(spark, rows):
    from lakeops.operators.merge import upsert_table

    schema = T.StructType().add("id", "integer").add("v", "string").add("bucket", "integer")
    path = new_folder(spark, "t")
    state = spark.createDataFrame([(1, "a", 1), (2, "b", 0), (3, "c", 1)], schema)
    files.write_table(state, path, partition_by=["bucket"])
    feed = spark.createDataFrame([(3, "z", 1), (5, "e", 1)], schema)
    assert upsert_table(spark, path, schema, feed, ["id"], "bucket", fixed_partition=True) == [1]
    assert rows(spark.read.schema(schema).parquet(path), "id", "v") == [(1, "a"), (2, "b"), (3, "z"), (5, "e")]
