"""Folders for intermediate tables, below the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_local_base: str | None = None


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, which every executor can reach.

    Only a ``local[..]`` session without that setting gets a temporary folder.
    """
    global _local_base
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if _local_base is None:
        _local_base = tempfile.mkdtemp(prefix="run-")
    return _local_base


def new_folder(spark: SparkSession, name: str) -> str:
    """A path that no other run uses."""
    return f"{shared_folder(spark)}/lakeops/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that is read several times once, and read it back.

    The lineage ends at the written table, so a lost executor does not repeat the work, and
    Spark knows the size when it chooses a join.
    """
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
