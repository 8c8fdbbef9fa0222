"""Grouped reports."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.numbers import ratio_pct, round_to


def group_averages(
    df: DataFrame, group: Sequence[str], values: dict[str, Column], count_as: str, digits: int = 2
) -> DataFrame:
    """Row count and rounded means per group; NULL keys are a group of their own."""
    means = [round_to(F.avg(v), digits).alias(name) for name, v in values.items()]
    return df.groupBy(*group).agg(F.count("*").alias(count_as), *means)


def group_ratios(
    df: DataFrame, group: Sequence[str], ratios: dict[str, tuple[str, str]], distinct: dict[str, str]
) -> DataFrame:
    """Percentages of summed columns (NULL when the whole is 0) and distinct counts."""
    return df.groupBy(*group).agg(
        *[ratio_pct(part, whole).alias(name) for name, (part, whole) in ratios.items()],
        *[F.count_distinct(c).alias(name) for name, c in distinct.items()],
    )


def range_profile(df: DataFrame, date: str) -> DataFrame:
    """Row count, first and last value, number of different years (first four characters)."""
    text = F.col(date).cast("string")
    return df.agg(
        F.count("*").alias("total_rows"),
        F.min(date).alias("min_date"),
        F.max(date).alias("max_date"),
        F.count_distinct(F.substring(text, 1, 4)).alias("unique_years"),
    )


def run_stats(df: DataFrame, group: Sequence[str], value: str, digits: int = 2) -> DataFrame:
    """Runs, mean, least, greatest and sample deviation (0 below two runs) per group."""
    return df.groupBy(*group).agg(
        F.count(value).alias("runs"),
        round_to(F.avg(value), digits).alias("avg_value"),
        round_to(F.min(value), digits).alias("min_value"),
        round_to(F.max(value), digits).alias("max_value"),
        round_to(F.coalesce(F.stddev_samp(value), F.lit(0.0)), digits).alias("stddev_value"),
    )


def pivot_first(
    df: DataFrame, rows: Sequence[str], column: str, value: str, order: str, values: Sequence | None = None
) -> DataFrame:
    """Cross table of the first value, in ``order``, per cell.

    The columns are all values of ``column``, which are read first (Spark refuses more than
    its own limit). ``values`` chooses some of them.
    """
    return _pivoted(df, rows, column, values).agg(F.min_by(value, order))


def pivot_mean(
    df: DataFrame, rows: Sequence[str], column: str, value: str, digits: int = 2, values: Sequence | None = None
) -> DataFrame:
    """Cross table of rounded means per cell, with columns as in ``pivot_first``."""
    return _pivoted(df, rows, column, values).agg(round_to(F.avg(value), digits))


def _pivoted(df: DataFrame, rows: Sequence[str], column: str, values: Sequence | None):
    grouped = df.groupBy(*rows)
    return grouped.pivot(column) if values is None else grouped.pivot(column, list(values))


def row_counts(tables: dict[str, DataFrame], total: str = "TOTAL") -> DataFrame:
    """(table_name, row_count) per table and for all of them, as one job."""
    parts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in tables.items()
    ]
    counts = parts[0]
    for part in parts[1:]:
        counts = counts.unionAll(part)
    # one row per table from here on
    return (
        counts.rollup("table_name")
        .agg(F.sum("row_count").alias("row_count"))
        .withColumn("table_name", F.coalesce("table_name", F.lit(total)))
    )


def unpivot_positive(
    df: DataFrame, ids: Sequence[str], columns: dict[str, str], name: str, value: str
) -> DataFrame:
    """Wide to long, keeping values above zero; ``columns`` maps a column to its label."""
    renamed = df.select(*ids, *[F.col(c).alias(label) for c, label in columns.items()])
    return renamed.unpivot(list(ids), list(columns.values()), name, value).where(
        F.col(value).isNotNull() & (F.col(value) > 0)
    )
