"""Stream sources and sinks: message broker and files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def broker_options(servers: str, topic: str, starting: str = "earliest") -> dict[str, str]:
    """Options of a topic source; ``starting`` counts only when there is no checkpoint yet."""
    if starting not in ("earliest", "latest"):
        raise ValueError("starting must be 'earliest' or 'latest'")
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }


def read_topic(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest"
) -> DataFrame:
    """Unbounded frame of a topic (needs the Kafka connector on the class path)."""
    return spark.readStream.format("kafka").options(**broker_options(servers, topic, starting)).load()


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a batch of (key, value) messages to a topic (needs the Kafka connector)."""
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    messages.write.format("kafka").options(**options).save()


def read_files(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", max_files: int = 1000
) -> DataFrame:
    """Unbounded frame of the files that arrive under ``path``."""
    return (
        spark.readStream.format(fmt).schema(schema).option("maxFilesPerTrigger", max_files).load(path)
    )


def write_messages(messages: DataFrame, path: str, mode: str = "errorifexists", per_file: int = 0) -> None:
    """Land the ``value`` of a batch of messages as lines of compressed text files.

    JSON repeats every name in every message, so its files are many times the rows they come
    from. A task reads a compressed file whole: ``per_file`` limits the messages in one.
    """
    writer = messages.select("value").write.mode(mode).option("compression", "gzip")
    writer.option("maxRecordsPerFile", str(per_file)).text(path)
