"""Micro-batches merged into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.operators.dedupe import latest_per_key
from lakeops.operators.merge import upsert_table
from lakeops.sources.files import ensure_table


def upsert_stream(
    stream: DataFrame,
    path: str,
    checkpoint: str,
    schema: T.StructType,
    keys: Sequence[str],
    newest: Sequence[str],
    partition: str,
    trigger: dict,
    fixed_partition: bool = False,
) -> StreamingQuery:
    """Start a query that keeps the newest row of each key.

    A batch is reduced to one row per key and merged; a row older than the stored one, by all
    of ``newest``, is left out. Merging the same batch again changes nothing, so a repeated batch is safe.
    Partition by a bucket of the key (``fixed_partition``) where the table is large: a batch
    then reads only the buckets it has rows for.
    """
    ensure_table(stream.sparkSession, path, schema, [partition])

    def merge(batch: DataFrame, batch_id: int) -> None:
        rows = latest_per_key(batch, keys, newest)
        upsert_table(
            batch.sparkSession,
            path,
            schema,
            rows,
            keys,
            partition,
            newer_by=list(newest),
            check_unique=False,
            fixed_partition=fixed_partition,
        )

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
