"""Incremental loads: high-water marks, missing days, processing status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.dates import period
from lakeops.sources.files import write_table

# Fixed value: where a feed starts when its target is still empty.
DEFAULT_MARK = "2025-10-20 00:00:00"

STATUS_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("timestamp", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("destination", T.StringType()),
        T.StructField("last_processed_month", T.StringType()),
        T.StructField("total_records_processed", T.LongType()),
        T.StructField("partitions", T.ArrayType(T.StringType())),
        T.StructField("status", T.StringType()),
    ]
)


def high_water_mark(target: DataFrame, column: str, default=DEFAULT_MARK):
    """Greatest value of ``column``: one value, so that the filter on it reaches the scan."""
    mark = target.agg(F.max(column)).first()[0]
    return default if mark is None else mark


def newer_than(source: DataFrame, column: str, mark) -> DataFrame:
    """Rows strictly newer than the mark."""
    kind = source.select(column).schema[0].dataType
    return source.where(F.col(column) > F.lit(mark).cast(kind))


def incremental_rows(
    source: DataFrame, target: DataFrame, column: str, order: Sequence[str], default=DEFAULT_MARK
) -> DataFrame:
    """Rows of ``source`` the target does not have yet, oldest first."""
    mark = high_water_mark(target, column, default)
    return newer_than(source, column, mark).orderBy(column, *order)


def missing_days(loaded: DataFrame, column: str, until: DataFrame, until_column: str) -> DataFrame:
    """Days after the first loaded day, up to the last day of ``until``, that are not loaded."""
    day = F.col(column).cast("date")
    marks = loaded.select(day.alias("loaded_day"), F.lit(None).cast("date").alias("day")).unionAll(
        until.select(F.lit(None).cast("date"), F.col(until_column).cast("date"))
    )
    calendar = (
        marks.agg(F.date_add(F.min("loaded_day"), 1).alias("first"), F.max("day").alias("last"))
        .where("first <= last")
        .select(F.explode(F.sequence("first", "last")).alias("day"))
    )
    days = loaded.select(day.alias("day")).distinct()
    return calendar.join(days, "day", "left_anti").orderBy("day")


def run_record(
    processed: DataFrame,
    date: str,
    *,
    seq: int,
    timestamp: str,
    source: str,
    destination: str,
    partitions: Sequence[str],
) -> DataFrame:
    """One status row measured on the processed rows; the last month is computed."""
    return processed.agg(
        F.lit(seq).cast("long").alias("seq"),
        F.lit(timestamp).alias("timestamp"),
        F.lit(source).alias("source"),
        F.lit(destination).alias("destination"),
        period(F.max(date)).alias("last_processed_month"),
        F.count("*").alias("total_records_processed"),
        F.array(*[F.lit(p) for p in partitions]).alias("partitions"),
        F.lit("success").alias("status"),
    )


def append_status(path: str, record: DataFrame) -> None:
    """Add a record to the JSON control table; earlier records are its history."""
    write_table(record, path, mode="append", fmt="json")


def status_history(spark: SparkSession, path: str) -> DataFrame:
    """All records, newest first."""
    return spark.read.schema(STATUS_SCHEMA).json(path).orderBy(F.col("seq").desc())


def current_status(spark: SparkSession, path: str) -> DataFrame:
    """The newest record."""
    return status_history(spark, path).limit(1)
