"""Versioned tables: change rows by version, as-of reads, version log, schema changes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.dedupe import first_per_key
from lakeops.operators.quality import assert_unique
from lakeops.sources.files import read_parquet_merged, write_table
from lakeops.workspace import stored

META = ("_version", "_op")
UPSERT, DELETE = "upsert", "delete"


@dataclass(frozen=True)
class VersionedTable:
    """Change rows in Parquet, one partition per version, and one record per commit.

    A version stores the rows it changed, so an as-of read costs as much as the changes
    up to it; ``compact`` starts again from one state.
    """

    spark: SparkSession
    path: str
    keys: tuple[str, ...]

    def commit(self, rows: DataFrame, version: int, committed_at: str, op: str = UPSERT) -> None:
        """Store changed rows, one per key, as one version. Repeating a commit replaces it."""
        rows = stored(rows, "commit")
        assert_unique(rows, list(self.keys))
        folder = f"_version={version}"
        write_table(rows.withColumn("_op", F.lit(op)), f"{self.path}/rows/{folder}", mode="overwrite")
        record = self.spark.createDataFrame([(committed_at, op)], "committed_at string, operation string")
        write_table(record, f"{self.path}/commits/{folder}", mode="overwrite")

    def changes(self) -> DataFrame:
        rows = read_parquet_merged(self.spark, f"{self.path}/rows")
        return rows.withColumn("_version", F.col("_version").cast("long"))

    def as_of(self, version: int) -> DataFrame:
        """Rows as they were after ``version``; later partitions are not read."""
        return self._newest(self.changes().where(F.col("_version") <= version))

    def latest(self) -> DataFrame:
        return self._newest(self.changes())

    def _newest(self, changes: DataFrame) -> DataFrame:
        """The first version, which is the large one, gives way to the newest later rows.

        Only the later rows are grouped by key; the first version is streamed past them.
        """
        keys = list(self.keys)
        start = read_parquet_merged(self.spark, f"{self.path}/commits").agg(
            F.min(F.col("_version").cast("long"))
        )
        first = start.first()[0]
        base = changes.where(F.col("_version") == first)
        later = changes.where(F.col("_version") > first)
        newest = first_per_key(later, keys, [F.col("_version").desc()])
        kept = base.join(newest.select(*keys), keys, "left_anti").select(*changes.columns)
        return kept.unionByName(newest).where(F.col("_op") != DELETE).drop(*META)

    def log(self) -> DataFrame:
        """(version, committed_at, operation, changed_rows), newest first."""
        commits = read_parquet_merged(self.spark, f"{self.path}/commits")
        counts = self.changes().groupBy("_version").agg(F.count("*").alias("changed_rows"))
        return (
            commits.join(counts, "_version", "left")
            .select(
                F.col("_version").cast("long").alias("version"),
                F.col("committed_at").cast("timestamp_ntz").alias("committed_at"),
                "operation",
                F.coalesce("changed_rows", F.lit(0)).alias("changed_rows"),
            )
            .orderBy(F.col("version").desc())
        )

    def compact(self, path: str, version: int, committed_at: str) -> VersionedTable:
        """The state as of ``version`` as the only version of a new table."""
        table = VersionedTable(self.spark, path, self.keys)
        table.commit(self.as_of(version), version, committed_at)
        return table


def add_columns(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """New columns, NULL in the rows that are there."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in columns.items()})


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Without these columns; names that do not exist are ignored."""
    return df.drop(*columns)


def union_evolved(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of two schema versions together; what a version lacks is NULL."""
    return old.unionByName(new, allowMissingColumns=True)


def describe(df: DataFrame) -> DataFrame:
    """(column_name, data_type) in table order."""
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema.fields],
        "column_name string, data_type string",
    )


def schema_diff(before: DataFrame, after: DataFrame) -> DataFrame:
    """(column_name, type_before, type_after, change) of two schema versions."""
    old = describe(before).withColumnRenamed("data_type", "type_before")
    new = describe(after).withColumnRenamed("data_type", "type_after")
    change = (
        F.when(F.col("type_before").isNull(), "added")
        .when(F.col("type_after").isNull(), "dropped")
        .when(F.col("type_before") != F.col("type_after"), "changed")
        .otherwise("same")
    )
    return old.join(new, "column_name", "full_outer").withColumn("change", change)


def filled_counts(df: DataFrame, name: str) -> DataFrame:
    """(column_name, <name>): non-null values per column, in one aggregate."""
    counts = df.agg(*[F.count(F.col(c)).alias(c) for c in df.columns])
    pairs = F.array(
        *[F.struct(F.lit(c).alias("column_name"), F.col(c).alias(name)) for c in df.columns]
    )
    return counts.select(F.inline(pairs))


def empty_like(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of that schema."""
    return spark.createDataFrame([], schema)
