"""Table paths of the landing, processed and warehouse layers."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeops.sources.published import read_published

LAYERS = ("landing", "processed", "warehouse")


@dataclass(frozen=True)
class Lake:
    """Tables below one base path, one folder per layer."""

    base: str

    def path(self, layer: str, table: str) -> str:
        if layer not in LAYERS:
            raise ValueError(f"unknown layer {layer!r}, expected one of {LAYERS}")
        return f"{self.base.rstrip('/')}/{layer}/{table}"

    def read(
        self, spark: SparkSession, layer: str, table: str, schema: T.StructType | None = None
    ) -> DataFrame:
        """The table, a mart in its newest version.

        A schema is needed while a partitioned table is still empty.
        """
        if layer == "warehouse":
            return read_published(spark, self.path(layer, table), schema)
        reader = spark.read.schema(schema) if schema else spark.read
        return reader.parquet(self.path(layer, table))

    def register(
        self, spark: SparkSession, layer: str, table: str, schema: T.StructType | None = None
    ) -> None:
        """Make a table usable by name in SQL."""
        self.read(spark, layer, table, schema).createOrReplaceTempView(table)
