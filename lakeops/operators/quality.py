"""Data quality checks, each in one pass."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from lakeops.functions.numbers import round_to


def require_non_empty(df: DataFrame, what: str = "input") -> DataFrame:
    """Return ``df``, or raise when it has no row."""
    if df.isEmpty():
        raise ValueError(f"{what} has no rows; was it loaded?")
    return df


def assert_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Return ``df``, or raise when a (non-null) key occurs twice."""
    repeated = df.dropna(subset=list(keys)).groupBy(*keys).count().where("count > 1")
    example = repeated.limit(1).collect()
    if example:
        raise ValueError(f"key {list(keys)} is not unique, for example {example[0]}")
    return df


def quality_report(
    df: DataFrame, key: str, positive: str, critical: Sequence[str]
) -> DataFrame:
    """(check_name, expected, actual, status): unique key, positive amount, no critical nulls."""
    measured = df.agg(
        F.count("*").alias("total"),
        F.count_distinct(key).alias("keys"),
        F.count_if(F.col(positive) > 0).alias("positive"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
    )
    total, zero = F.col("total"), F.lit(0).cast("long")
    checks: list[tuple[str, Column, Column]] = [
        ("duplicates", total, F.col("keys")),
        (f"positive_{positive}", total, F.col("positive")),
        *[(f"null_{c}", zero, F.col(f"null_{c}")) for c in critical],
    ]
    return _report(measured, checks)


def _report(measured: DataFrame, checks: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("check_name"),
                expected.alias("expected"),
                actual.alias("actual"),
                F.when(expected == actual, "PASS").otherwise("FAIL").alias("status"),
            )
            for name, expected, actual in checks
        ]
    )
    return measured.select(F.inline(rows))


def checked_write(
    df: DataFrame, write: Callable[[DataFrame], None], positive: str, critical: Sequence[str]
) -> DataFrame:
    """Run ``write(df)`` and report on the rows in the pass that writes them.

    (check_name, expected, actual, status): some rows, positive amount, no critical nulls.
    The input is read once. A unique key needs all rows of a key together, see
    ``quality_report``. If a task runs again because an executor was lost, its rows may be
    counted twice on both sides of a check, so the status stays right.
    """
    seen = Observation()
    measures = [
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col(positive) > 0).alias("positive"),
        *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in critical],
    ]
    write(df.observe(seen, *measures))
    found = seen.get
    names = ["total", "positive", *[f"null_{c}" for c in critical]]
    measured = df.sparkSession.createDataFrame(
        [tuple(found[n] for n in names)], ", ".join(f"`{n}` long" for n in names)
    )
    total, zero = F.col("total"), F.lit(0).cast("long")
    some = F.greatest(total, F.lit(1).cast("long"))
    return _report(
        measured,
        [
            ("some_rows", some, total),
            (f"positive_{positive}", total, F.col("positive")),
            *[(f"null_{c}", zero, F.col(f"null_{c}")) for c in critical],
        ],
    )


def null_profile(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """(column_name, null_count, null_pct) for named null tests, in one aggregate."""
    total = F.count("*")
    measured = df.agg(
        total.alias("total"), *[F.count_if(t).alias(f"n_{i}") for i, t in enumerate(tests.values())]
    )
    rows = F.array(
        *[
            F.struct(
                F.lit(name).alias("column_name"),
                F.col(f"n_{i}").alias("null_count"),
                round_to(F.col(f"n_{i}") / F.nullif(F.col("total"), F.lit(0)) * 100).alias("null_pct"),
            )
            for i, name in enumerate(tests)
        ]
    )
    return measured.select(F.inline(rows))


def coverage(df: DataFrame, matched: Column, score: Column, low_below: float = 0.95) -> DataFrame:
    """Counts of matched, unmatched and low-confidence rows, and the share matched in percent."""
    low = matched & (score < low_below)
    return df.agg(
        F.count("*").alias("total"),
        F.count_if(matched).alias("matched"),
        F.count_if(~matched).alias("unmatched"),
        round_to(F.count_if(matched) / F.nullif(F.count("*"), F.lit(0)) * 100, 1).alias("coverage_pct"),
        F.count_if(low).alias("low_confidence"),
    )
