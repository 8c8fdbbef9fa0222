"""Named batches in a folder, replaced as a whole and never half read."""

from __future__ import annotations

import time
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


class BatchFolder:
    """Batches of rows below ``path``, each attempt to write one in a folder of its own.

    An attempt counts once a row names it in the table of commits (``path``-commits), which is
    written after the attempt, as one file. Until then readers see the earlier attempt, or
    none, so a repeated batch is never missing and never counted twice. Of several commits of
    a batch the latest counts.
    """

    commits_schema = "batch string, attempt string, at bigint, folded boolean"

    def __init__(self, spark: SparkSession, path: str, schema: str):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema

    def _read(self, path: str, schema: str) -> DataFrame:
        """The rows of a folder; none if it is not there yet."""
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            # not from Python rows: they start a further daemon in every executor, with workers of its own
            return self.spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(schema)))

    def current(self) -> DataFrame:
        """batch, attempt, at, folded: the attempt that counts for each batch."""
        commits = self._read(f"{self.path}-commits", self.commits_schema)
        newest = F.max_by(F.struct("attempt", "at", "folded"), F.struct("at", "attempt"))
        return commits.groupBy("batch").agg(newest.alias("c")).select("batch", "c.*")

    def names(self) -> DataFrame:
        return self.current().select("batch")

    def read(self) -> DataFrame:
        """The rows of all batches, each once, with ``batch`` (of a fold: its first batch)."""
        rows = self._read(self.path, f"{self.schema}, batch string, attempt string")
        counted = self.current().select("attempt").distinct()
        return rows.join(counted, "attempt", "left_semi").drop("attempt")

    def _attempt(self, batch: str, rows: DataFrame) -> str:
        attempt = uuid.uuid4().hex
        rows.write.parquet(f"{self.path}/batch={batch}/attempt={attempt}")
        return attempt

    def _commit(self, rows: DataFrame) -> None:
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}-commits")

    def write(self, batch: str, rows: DataFrame) -> bool:
        """Write a batch or replace it. A batch that was folded counts already and is left out."""
        if not batch or not all(c.isalnum() or c in "-_" for c in batch):
            raise ValueError("a batch is named by letters, digits, - and _")
        if not self.current().filter((F.col("batch") == batch) & F.col("folded")).isEmpty():
            return False
        attempt = self._attempt(batch, rows)
        row = {"batch": batch, "attempt": attempt, "at": time.time_ns(), "folded": False}
        self._commit(self.spark.range(1).select(*(F.lit(v).alias(c) for c, v in row.items())))
        return True

    def fold(self, merge) -> None:
        """Replace the rows of all batches by ``merge`` of them, and keep the batches' names.

        The commits of the fold are written together. No batch may be written meanwhile.
        """
        held = self.current()
        first = held.agg(F.min("batch")).first()[0]
        if first is None:
            return
        attempt = self._attempt(first, merge(self.read().drop("batch")))
        self._commit(
            held.select(
                "batch", F.lit(attempt).alias("attempt"), F.lit(time.time_ns()).alias("at"), F.lit(True).alias("folded")
            )
        )
