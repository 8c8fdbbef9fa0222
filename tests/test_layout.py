"""Tables laid out for joins and filters: what their plans and scans do, and checks in a write's own pass."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from lakeops.operators.quality import checked_write
from lakeops.plans.analytics import BucketedTables, bucketed_three_way
from lakeops.plans.views import box
from lakeops.sources.bucketed import _range_of, clustered, curve, store_bucketed, write_clustered
from lakeops.workspace import new_folder
from tests.conftest import SF_DIR


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def nodes(plan):
    """All nodes of an executed plan, also of adaptive ones."""
    if plan.getClass().getSimpleName() == "AdaptiveSparkPlanExec":
        return nodes(plan.executedPlan())
    found = [plan]
    if "QueryStage" in plan.getClass().getSimpleName():
        return found + nodes(plan.plan())
    children = plan.children()
    for i in range(children.size()):
        found += nodes(children.apply(i))
    return found


def scanned(df):
    """Rows that the scans of an executed frame gave out."""
    df.collect()
    scans = [n for n in nodes(df._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "FileSourceScanExec"]
    assert scans
    return sum(s.metrics().apply("numOutputRows").value() for s in scans)


def test_bucketed_facts_are_not_exchanged(spark, no_broadcast):
    df = bucketed_three_way(BucketedTables(spark, SF_DIR))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "Exchange" not in plan
    assert df.count() == 1000


def test_bucketed_tables_hold_all_rows(spark):
    rows = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    table = store_bucketed(rows, ["k"], buckets=4, sort_by=["id"])
    assert table.exceptAll(rows).count() == 0 and table.count() == 1000
    grouped = table.groupBy("k", "id").count()
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert len(table.inputFiles()) == 4


@pytest.mark.parametrize("column", ["playerteamname", "personid"])
def test_clustered_files_are_skipped(spark, tables, column):
    """Filters by team and by person both read a part of the rows, whichever comes first."""
    rows = box(tables)
    path = new_folder(spark, "clustered")
    write_clustered(rows, path, ["playerteamname", "personid"], bloom={"personid": 1000}, files=16)
    stored = spark.read.schema(rows.schema).parquet(path)
    value = rows.groupBy(column).count().orderBy("count", column).first()[0]
    wanted = stored.where(F.col(column) == value)
    total = rows.count()
    assert 0 < scanned(wanted) < total / 3
    assert wanted.count() == rows.where(F.col(column) == value).count()
    assert stored.exceptAll(rows).count() == 0 and stored.count() == total


def test_bloom_filters_skip_values_between_least_and_greatest(spark):
    """Even ids only: an odd one lies within the range of every file that could hold it."""
    rows = spark.range(0, 100_000, 2).select("id", (F.col("id") % 7).alias("k"))
    read = []
    for bloom in ({}, {"id": 20_000}):
        path = new_folder(spark, "bloom")
        write_clustered(rows, path, ["k"], bloom=bloom, files=4)
        read.append(scanned(spark.read.parquet(path).where("id = 50001")))
    assert read[0] > 0 and read[1] < read[0]


def test_curve_takes_any_values(spark):
    df = spark.createDataFrame([(None, None), ("b", 1.5), ("a", -2.0), ("é", 9.0)], "s string, x double")
    places = [r[0] for r in df.select(curve(df, ["s", "x"])).collect()]
    assert places[0] == 0 and len(set(places)) >= 3
    empty = df.limit(0)
    assert empty.select(curve(empty, ["s", "x"])).count() == 0


def test_rows_are_clustered_by_a_column(spark):
    """The place on the curve is worked out once for each row, not for each comparison of the sort."""
    df = spark.range(1000).select((F.col("id") % 37).alias("k"), "id")
    dealt = clustered(df, ["k", "id"], 4)
    order = [n for n in nodes(dealt._jdf.queryExecution().executedPlan()) if n.getClass().getSimpleName() == "SortExec"]
    keys = [k.child().getClass().getSimpleName() for n in order for k in (n.sortOrder().apply(i) for i in range(3))]
    assert keys == ["AttributeReference"] * 3
    assert "rangepartitioning(_place_" in dealt._jdf.queryExecution().executedPlan().toString()
    assert dealt.columns == df.columns and dealt.exceptAll(df).count() == 0 and dealt.count() == 1000


@pytest.mark.parametrize("cuts", [[], ["b"], ["b", "d"], ["b", "d", "e", "é"], list("bdefg")])
def test_ranges_are_found_by_halving(spark, cuts):
    values = [None, "", "a", "b", "c", "d", "dd", "e", "g", "z", "é"]
    df = spark.createDataFrame([(v,) for v in values], "s string").select("s", _range_of(F.col("s"), cuts).alias("n"))
    assert {r.s: r.n for r in df.collect()} == {v: sum(v is not None and c <= v for c in cuts) for v in values}
    assert "lambda" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_checks_in_the_pass_that_writes(spark):
    """The report takes no job of its own, and the input is read once."""
    reads = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    rows = spark.createDataFrame([(1, 2.0), (2, None), (None, -1.0)], "id long, x double").mapInArrow(count, "id long, x double")
    path = new_folder(spark, "checked")
    report = checked_write(rows, lambda df: df.write.parquet(path), "x", ["id", "x"])
    found = {r.check_name: (r.expected, r.actual, r.status) for r in report.collect()}
    assert found == {
        "some_rows": (3, 3, "PASS"), "positive_x": (3, 1, "FAIL"), "null_id": (0, 1, "FAIL"), "null_x": (0, 1, "FAIL"),
    }
    assert reads.value == 3 and spark.read.parquet(path).count() == 3
    empty = checked_write(rows.limit(0), lambda df: df.write.format("noop").mode("overwrite").save(), "x", [])
    assert [r.status for r in empty.orderBy("check_name").collect()] == ["PASS", "FAIL"]
