"""Spark session settings."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may be changed on a running session.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # One key may hold a third of the rows: split its partition at run time, also
    # where that costs a further exchange for the aggregate above the join.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}

# Bytes of input for each partition that a shuffle starts with.
PARTITION_BYTES = 256 * 1024 * 1024

# Settings of a new session. Call sites in error messages cost several calls to the JVM per
# column expression, which is a good part of the time of a short query.
SESSION_SETTINGS = {"spark.python.sql.dataFrameDebugging.enabled": "false"}


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the run-time settings to a session made elsewhere, where it does not say otherwise."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) is None:
            spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "lakeops",
    master: str | None = None,
    settings: dict[str, str] | None = None,
    input_bytes: int | None = None,
) -> SparkSession:
    """A session with the library's settings; ``master`` is left to spark-submit when None.

    With ``input_bytes``, shuffles start with a partition for each PARTITION_BYTES of it, and
    adaptive execution joins the small ones.
    """
    if input_bytes:
        parts = max(200, -(-input_bytes // PARTITION_BYTES))
        settings = {
            "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(parts)
        } | (settings or {})
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_SETTINGS, **SESSION_SETTINGS, **(settings or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
