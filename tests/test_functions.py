"""Column expressions: casts, ids, names, JSON, dates, money."""

from __future__ import annotations

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions import dates, numbers, sales, text
from lakeops.schemas import BOX_SCORE_FILE_NAMES, BOX_SCORE_LANDING, BOX_SCORE_PROCESSED
from lakeops.sources.files import lenient_select


def one(df):
    return [r[0] for r in df.collect()]


def texts(spark, values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string").orderBy("i")


def test_normalize_id(spark):
    df = texts(spark, ["204001.0", "12", "012", "abc", "", None, "9007199254740993"])
    got = one(df.select(text.normalize_id("x")))
    assert got == ["204001", "12", "12", "abc", "", "", "9007199254740993"]


def test_lenient_numbers(spark):
    df = texts(spark, ["1.0", "x", "", None, "7", "-2.9"])
    assert one(df.select(numbers.lenient_int("x"))) == [1, None, None, None, 7, -2]
    assert one(df.select(numbers.lenient_long("x"))) == [1, None, None, None, 7, -2]


def test_lenient_flag(spark):
    df = texts(spark, ["1", "0", "1.0", "true", "no", "maybe", None])
    assert one(df.select(numbers.lenient_flag("x"))) == [True, False, True, True, False, None, None]


def test_lenient_timestamp(spark):
    df = texts(spark, ["2025-10-21 19:30:00", "2025-13-01", "soon", None])
    got = one(df.select(dates.lenient_timestamp("x")))
    assert got == [dt.datetime(2025, 10, 21, 19, 30), None, None, None]
    day = one(df.select(dates.lenient_timestamp(F.lit("20251021"), "yyyyMMdd")).limit(1))
    assert day == [dt.datetime(2025, 10, 21)]


def test_round_half_up(spark):
    df = spark.createDataFrame([(1, 2.675), (2, 0.125), (3, -0.125), (4, None)], "i int, x double")
    assert one(df.orderBy("i").select(numbers.round_to("x", 2))) == [2.68, 0.13, -0.13, None]


def test_exact_sum_has_no_order_effect(spark):
    df = spark.createDataFrame([(0.1,)] * 10 + [(None,)], "x double")
    assert df.agg(numbers.exact_sum("x"), numbers.exact_avg("x")).first() == (1.0, 0.1)
    assert df.limit(0).agg(numbers.exact_sum("x"), numbers.exact_avg("x")).first() == (None, None)


def test_ratio_is_null_without_attempts(spark):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 2), ("b", 0, 0)], "t string, made int, tried int")
    got = df.groupBy("t").agg(numbers.ratio_pct("made", "tried").alias("p")).orderBy("t").collect()
    assert [r.p for r in got] == [50.0, None]


def test_name_parts(spark):
    df = texts(spark, ["Santi Aldama", "Jaime Jaquez Jr.", "Nene", " Ana  Bo ", None])
    assert one(df.select(text.first_token("x")))[:3] == ["Santi", "Jaime", "Nene"]
    assert one(df.select(text.after_first_token("x")))[:3] == ["Aldama", "Jaquez Jr.", "Nene"]
    assert one(df.select(text.name_key("x")))[0::4] == ["santi aldama", None]


def test_flags(spark):
    df = texts(spark, ["3PT Field Goal", "2PT Field Goal", None])
    assert one(df.select(text.contains_flag("x", "3PT"))) == [1, 0, 0]
    assert one(df.select(text.equals_flag("x", "3PT Field Goal"))) == [1, 0, 0]
    assert one(texts(spark, ["12", "1a", "", None]).select(text.is_digits("x"))) == [True, False, False, None]


def test_typed_defaults(spark):
    df = spark.createDataFrame([(None, None, None, None)], "i int, d double, s string, t timestamp")
    assert text.typed_defaults(df).first() == (0, 0.0, "", None)


def test_parse_json_keeps_good_fields(spark):
    schema = T.StructType().add("a", "integer").add("b", "integer")
    df = texts(spark, ["{bad", '{"a":"z","b":1}', "{}", '{"a":2,"b":3,"c":4}', None])
    assert [tuple(r) for r in text.parse_json(df, schema, "x").collect()] == [
        (None, None), (None, 1), (None, None), (2, 3), (None, None),
    ]
    kept = one(text.parse_json(df, schema, "x", corrupt="bad").select("bad"))
    assert kept == ["{bad", '{"a":"z","b":1}', None, None, None]


def test_messages_keep_microseconds_and_nulls(spark):
    schema = T.StructType().add("id", "integer").add("ts", "timestamp_ntz").add("s", "string")
    row = (1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575), None)
    sent = text.to_messages(spark.createDataFrame([row], schema), key="id")
    assert sent.first().key == "1" and '"s":null' in sent.first().value
    assert tuple(text.parse_json(sent, schema).first()) == row


def test_season_start_year(spark):
    df = texts(spark, ["2024-09-30", "2024-10-01", "2024-12-31", "2025-01-01"])
    got = one(df.select(dates.season_start_year(F.col("x").cast("date"))))
    assert got == [2023, 2024, 2024, 2024]


def test_next_period(spark):
    df = texts(spark, ["2018-03", "2018-12", None])
    assert one(df.select(dates.next_period("x"))) == ["2018-04", "2019-01", "2018-01"]


@pytest.mark.parametrize(
    ("amount", "days", "percent"),
    [(1000.0, 180, 3), (1000.01, 180, 5), (1000.0, 181, 4), (1000.01, 181, 6), (None, 181, 4), (5000.0, None, 5)],
)
def test_commission(spark, amount, days, percent):
    hired = dt.date(2020, 1, 1)
    sold = None if days is None else hired + dt.timedelta(days=days)
    df = spark.createDataFrame([(amount, sold, hired)], "a double, s date, h date")
    assert df.select(sales.commission_rate("a", "s", "h")).first()[0] == percent / 100
    paid = df.select(sales.commission("a", sales.commission_percent("a", "s", "h"))).first()[0]
    if amount is None:
        assert paid is None
    else:
        assert paid == pytest.approx(amount * percent / 100, abs=0.0051)


def test_commission_rounds_half_up(spark):
    df = spark.createDataFrame([(0.5,), (0.1,), (1234.5,)], "a double")
    # 0.5 * 5% = 0.025, 0.1 * 5% = 0.005, 1234.5 * 5% = 61.725
    assert one(df.select(sales.commission("a", F.lit(5)))) == [0.03, 0.01, 61.73]


def test_lenient_select_of_box_scores(spark):
    names = [BOX_SCORE_FILE_NAMES.get(f.name, f.name) for f in BOX_SCORE_LANDING.fields]
    values = ["x"] * len(names)
    values[names.index("personId")] = "2544.0"
    values[names.index("plusMinusPoints")] = "-7.0"
    values[names.index("win")] = "1"
    values[names.index("gameDateTimeEst")] = "2025-10-21 19:30:00"
    raw = spark.createDataFrame([values], T.StructType([T.StructField(n, T.StringType()) for n in names]))
    got = lenient_select(raw, BOX_SCORE_PROCESSED, BOX_SCORE_FILE_NAMES).first()
    assert (got.personId, got.plusMinus, got.win, got.points, got.gameId) == (2544, -7, True, None, None)
    assert got.gameDateTimeEst == dt.datetime(2025, 10, 21, 19, 30)


def test_sums_keep_all_decimals(spark):
    df = spark.createDataFrame([(0.125,), (0.125,), (0.004,), (None,)], "x double")
    assert df.agg(numbers.exact_avg("x")).first()[0] == 0.254 / 3
    many = spark.range(1000).select(F.lit(1.004).alias("x"), F.lit(-0.5).alias("y"), F.lit(2e15).alias("z"))
    assert many.agg(*[numbers.exact_sum(c) for c in "xyz"]).first()[:] == (1004.0, -500.0, 2e18)
    assert df.where("x > 1").agg(numbers.exact_sum("x"), numbers.exact_avg("x")).first()[:] == (None, None)


def test_rounding_has_no_cap(spark):
    df = spark.createDataFrame([(2e9 + 0.125,), (3e17,), (1e300,), (2.675,), (None,)], "x double")
    assert one(df.select(numbers.round_to("x"))) == [2000000000.13, 3e17, 1e300, 2.68, None]


def test_lenient_casts_of_large_and_bad_text(spark):
    texts = ["9223372036854775807", "9223372036854775808", "1e30", "99999999999", "x1", "1.5e3", " 7 "]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    assert one(df.select(numbers.lenient_long("x"))) == [2**63 - 1, None, None, 99999999999, None, 1500, 7]
    assert one(df.select(numbers.lenient_int("x"))) == [None, None, None, None, None, 1500, 7]


def test_exact_sum_holds_any_group(spark):
    """Large numbers, infinities and NaN add up as in a plain sum, and limbs of 2e10 rows carry."""
    total = lambda *xs: spark.createDataFrame([(float(x),) for x in xs], "x double").agg(numbers.exact_sum("x")).first()[0]
    assert total(5e18, 5e18) == 1e19 and total(1e19) == 1e19 and total(-1e300, 1) == -1e300
    assert total("inf", 1) == float("inf") and total("-inf", 0.5) == float("-inf")
    assert total(1, "nan") != total(1, "nan") and total("inf", "-inf") != total("inf", "-inf")
    assert total(-0.5, -0.25, 2**53, 1, -(2.0**53)) == 0.25
    assert total(9e17, 9e17, -9e17, 0.125) == 9e17
    xs = [0.5, 123456789.987654321, -77777.25, 999999999999.999, -1e17]
    rows = 20_000_000_000
    one = spark.createDataFrame([(x,) for x in xs], "x double")
    for x in xs:
        whole, billionths = numbers._limbs(F.lit(x))
        scaled = [[F.sum(limb * F.lit(rows)) for limb in part] for part in (whole, billionths)]
        got = one.limit(1).agg(numbers.exact_total(*scaled)).first()[0]
        want = (int(math.floor(x)) * 10**9 + math.floor((x - math.floor(x)) * 10**9 + 0.5)) * rows
        assert got == want / 10**9
