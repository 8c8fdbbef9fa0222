"""Windows give the same rows whether long groups are split or not."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from lakeops.operators import windows
from lakeops.operators.dedupe import drop_duplicates_stable, first_per_key, latest_per_key, with_cast_keys

SPLIT = {"max_rows": 7}


@pytest.fixture(scope="module")
def series(spark):
    """One entity owns most rows; times are uneven, equal and missing."""
    out = []
    for i in range(400):
        who = 1 if i % 4 else 2 + i % 9
        step = i * i if i % 3 else i // 2 * 2
        ts = None if i % 97 == 5 else dt.datetime(2024, 1, 1) + dt.timedelta(seconds=step)
        out.append((who if i % 50 else None, ts, i, float(i * 7 % 31) if i % 5 else None, str(i % 11)))
    return spark.createDataFrame(
        out, "who int, ts timestamp_ntz, id int, value double, tag string"
    ).repartition(5)


def same(a, b):
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


def piece_sizes(df, keys, order, max_rows):
    levels = windows._levels(df, keys, order, max_rows)
    pieces = windows._with_pieces(df, levels, keys, order)
    assert pieces.count() == df.count()
    counted = pieces.groupBy(*keys, "_piece").count().orderBy(*keys, "_piece")
    return [(r[0], tuple(r["_piece"]), r["count"]) for r in counted.collect()]


def test_groups_are_split(series):
    sizes = piece_sizes(series, ["who"], ["ts", "id"], 7)
    assert len([s for s in sizes if s[0] == 1]) > 20
    assert max(n for _, _, n in sizes) <= 7
    # short groups stay whole
    assert {who for who, piece, _ in piece_sizes(series, ["who"], ["ts", "id"], 20) if piece == ()} >= {2, 3}


def test_outliers_do_not_keep_a_group_together(spark):
    """Half the rows in one second, one row decades earlier and one without time."""
    start = dt.datetime(2024, 1, 1)
    times = [None, dt.datetime(1970, 1, 1)] + [start + dt.timedelta(microseconds=i // 2) for i in range(300)]
    times += [start + dt.timedelta(days=i) for i in range(300)]
    df = spark.createDataFrame(
        [("a", t, i, float(i % 13)) for i, t in enumerate(times)], "who string, ts timestamp_ntz, id int, value double"
    )
    sizes = piece_sizes(df, ["who"], ["ts", "id"], 10)
    assert max(n for _, _, n in sizes) <= 10
    args = (df, ["who"], ["ts", "id"], "value", "avg")
    same(windows.rolling_avg(*args), windows.rolling_avg(*args, max_rows=10))


def test_one_moment_is_split_along_the_next_column(spark):
    big = 2**53
    rows = [("a", 5, big + i, i, float(i % 7)) for i in range(80)] + [("b", None, i, i, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, "who string, at int, id bigint, tie int, value double")
    assert max(n for _, _, n in piece_sizes(df, ["who"], ["at", "id"], 10)) <= 10
    args = (df, ["who"], ["at", "id"], "value", "avg")
    same(windows.rolling_avg(*args), windows.rolling_avg(*args, max_rows=10))


def test_ids_of_one_position_stay_in_order(spark):
    """Ids that are equal as DOUBLE must not be split along the column after them."""
    rows = [("a", 2**60 + i, -i, float(i % 7)) for i in range(60)]
    df = spark.createDataFrame(rows, "who string, id bigint, tie int, value double")
    args = (df, ["who"], ["id", "tie"], "value", "avg")
    same(windows.rolling_avg(*args), windows.rolling_avg(*args, max_rows=10))


@pytest.mark.parametrize("rows", [2, 5, 12])
def test_rolling_avg(series, rows):
    args = (series, ["who"], ["ts", "id"], "value", "avg")
    same(windows.rolling_avg(*args, rows=rows), windows.rolling_avg(*args, rows=rows, **SPLIT))


def test_previous_date(series):
    df = series.withColumn("day", F.col("ts").cast("date"))
    args = (df, ["who"], ["day", "id"], "day", "prev", "flag")
    same(windows.with_previous_date(*args), windows.with_previous_date(*args, **SPLIT))


@pytest.mark.parametrize("wanted", ["3", "never"])
def test_carry_forward(series, wanted):
    args = (series, ["who"], ["ts", "id"], F.col("id"), F.col("tag") == wanted, "last", -1)
    same(windows.carry_forward(*args), windows.carry_forward(*args, **SPLIT))


def test_text_order_is_split(spark):
    texts = ["same beginning " + str(i % 40).zfill(2) for i in range(120)] + [None, "é", ""]
    df = spark.createDataFrame(
        [(1, x, i, float(i)) for i, x in enumerate(texts)], "who int, at string, id int, value double"
    )
    args = (df, ["who"], ["at", "id"], "value", "avg")
    same(windows.rolling_avg(*args), windows.rolling_avg(*args, **SPLIT))
    assert windows._levels(df, ["who"], ["at", "id"], 7)


def test_empty_input(series):
    args = (series.limit(0), ["who"], ["ts", "id"], "value", "avg")
    assert windows.rolling_avg(*args, **SPLIT).count() == 0


def test_back_to_back(spark):
    days = ["2024-01-01", "2024-01-02", "2024-01-02", "2024-01-04"]
    df = spark.createDataFrame(
        [(1, dt.date.fromisoformat(d), i) for i, d in enumerate(days)], "p int, day date, g int"
    )
    got = windows.with_previous_date(df, ["p"], ["day", "g"], "day").orderBy("g").collect()
    assert [r.is_back_to_back for r in got] == [False, True, False, False]
    assert got[0].prev_game_date is None


def test_top_per_group_keeps_ties(spark, rows):
    df = spark.createDataFrame([("t", "a", 5), ("t", "b", 5), ("t", "c", 4), (None, "d", 1)], "t string, n string, v int")
    assert rows(windows.top_per_group(df, ["t"], "v"), "n") == [("a",), ("b",), ("d",)]


def test_dedupe(spark, rows):
    df = spark.createDataFrame(
        [("012", 1, "a"), ("12", 2, "b"), ("x", 3, "c"), (None, 4, "d")], "id string, at int, v string"
    )
    typed = with_cast_keys(df, {"id": "bigint"})
    assert rows(latest_per_key(typed, ["id"], ["at"])) == [(12, 2, "b")]
    assert rows(first_per_key(typed, ["id"], ["at"])) == [(12, 1, "a")]
    assert with_cast_keys(df, {"id": "bigint"}, drop_null=False).count() == 4
    twice = df.unionAll(df.withColumn("at", F.col("at") + 1))
    assert rows(drop_duplicates_stable(twice, ["id"])) == rows(df)


def test_rank_filter_runs_before_the_shuffle(tables):
    plan = latest_per_key(tables.read("lineitem"), ["l_orderkey"], ["l_shipdate"])
    text = plan._jdf.queryExecution().executedPlan().toString()
    below = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in below
