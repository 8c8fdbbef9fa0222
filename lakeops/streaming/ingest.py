"""JSON messages to an append-only table, each message once, at intervals or until done."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lakeops.functions.text import parse_json

# Micro-batch intervals of the feeds.
EVERY_5_SECONDS = {"processingTime": "5 seconds"}
EVERY_10_SECONDS = {"processingTime": "10 seconds"}
UNTIL_DONE = {"availableNow": True}


def widen_schema(schema: T.StructType, fields: Sequence[T.StructField]) -> T.StructType:
    """Schema with new nullable fields; messages without them give NULL."""
    known = set(schema.fieldNames())
    added = [T.StructField(f.name, f.dataType, True) for f in fields if f.name not in known]
    return T.StructType([*schema.fields, *added])


def once_within(
    rows: DataFrame, keys: Sequence[str], event_time: str, delay: str
) -> DataFrame:
    """A stream without repeats of ``keys`` whose times lie within ``delay`` of each other.

    The keys seen are kept until the newest time has passed theirs by ``delay``, so the state
    follows the rate of messages, not their history. A row that is later than ``delay`` when
    its batch starts is left out, as its first sending may be forgotten. Rows without a time
    are never late: their keys are kept.
    """
    return (
        rows.withColumn("_time", F.col(event_time).cast("timestamp"))
        .withWatermark("_time", delay)
        .dropDuplicatesWithinWatermark(list(keys))
        .drop("_time")
    )


def run_to_idle(query: StreamingQuery) -> DataFrame:
    """Let a query with an interval trigger take all there is, stop it, and tell of its batches.

    A row for each batch with rows that Spark still remembers: batch, rows, state_rows,
    late_rows.
    """
    try:
        query.processAllAvailable()
    finally:
        query.stop()
    found = []
    for p in query.recentProgress:
        states = p.stateOperators
        found.append(
            (
                p.batchId, p.numInputRows, sum(s.numRowsTotal for s in states),
                sum(s.numRowsDroppedByWatermark for s in states),
            )
        )
    kind = "batch bigint, rows bigint, state_rows bigint, late_rows bigint"
    return SparkSession.active().createDataFrame(found, kind).filter("rows > 0")


def ingest_json_stream(
    messages: DataFrame,
    schema: T.StructType,
    path: str,
    checkpoint: str,
    *,
    trigger: dict | None = None,
    partition_by: Sequence[str] = (),
    corrupt: str | None = None,
    once: tuple[Sequence[str], str, str] | None = None,
) -> StreamingQuery:
    """Start a query that parses the ``value`` of each message and appends the columns.

    The checkpoint keeps offsets and the file sink keeps its commits, so a restarted query
    goes on where it stopped and writes each message once. ``once`` (keys, time, delay) also
    leaves out messages that were sent again, see ``once_within``.
    """
    rows = parse_json(messages, schema, corrupt=corrupt)
    writer = (
        (once_within(rows, *once) if once else rows)
        .writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or EVERY_5_SECONDS))
    )
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start()
