"""Streams give the batch result, also after a restart and with repeated batches."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import to_messages
from lakeops.operators.dedupe import latest_per_key
from lakeops.plans import load_all
from lakeops.schemas import DRIVER_TABLES
from lakeops.sources.streams import read_files, write_messages
from lakeops.streaming.ingest import UNTIL_DONE, ingest_json_stream, run_to_idle, widen_schema
from lakeops.streaming.upsert import upsert_stream
from lakeops.workspace import new_folder, shared_folder
from tests.conftest import SF_DIR

EVENTS = DRIVER_TABLES["events"]


def events(tables):
    return tables.read("events").withColumn("day", F.col("ts").cast("date"))


def test_ingest_goes_on_after_a_restart(spark, tables, rows):
    folder, path, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    all_rows = tables.read("events")
    half = F.col("event_id") < 500
    for part in (half, ~half):
        all_rows.where(part).write.mode("append").parquet(folder)
        messages = to_messages(read_files(spark, folder, EVENTS))
        ingest_json_stream(messages, EVENTS, path, checkpoint, trigger=UNTIL_DONE).awaitTermination()
    assert rows(spark.read.schema(EVENTS).parquet(path)) == rows(all_rows)


def test_new_field_is_null_in_old_messages(spark, rows):
    wide = widen_schema(T.StructType().add("a", "integer"), [T.StructField("b", T.StringType(), False)])
    folder, path, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    spark.createDataFrame([('{"a":1}',), ('{"a":2,"b":"x"}',), ("{bad",)], "value string").write.text(folder)
    messages = read_files(spark, folder, T.StructType().add("value", "string"), fmt="text")
    ingest_json_stream(messages, wide, path, checkpoint, trigger=UNTIL_DONE, corrupt="raw").awaitTermination()
    assert rows(spark.read.parquet(path)) == [(None, None, "{bad"), (1, None, None), (2, "x", None)]


def test_upsert_stream_keeps_the_newest(spark, tables, rows):
    folder, path, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    wanted = rows(latest_per_key(events(tables), ["user_id"], ["ts", "event_id"]), "user_id", "event_id", "day")
    # files in no order of time, so that late rows come in later batches
    events(tables).repartition(6, F.hash("event_id")).write.parquet(folder)
    schema = events(tables).schema

    def run(checkpoint):
        stream = read_files(spark, folder, schema, max_files=2)
        upsert_stream(
            stream, path, checkpoint, schema, ["user_id"], ["ts", "event_id"], "day", UNTIL_DONE
        ).awaitTermination()
        return rows(spark.read.schema(schema).parquet(path), "user_id", "event_id", "day")

    assert run(checkpoint) == wanted
    # every batch again, as after a lost checkpoint
    assert run(new_folder(spark, "cp2")) == wanted


TIMED = T.StructType().add("id", "integer").add("at", "timestamp")


def test_a_message_sent_twice_lands_once(spark, rows):
    """Repeats within a batch, in a later batch and after a restart; state follows the delay."""
    folder, path, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    sent, metrics = [], []
    for batch in range(6):
        own = [(10 * batch + i, f"2024-01-01 {batch:02d}:{i:02d}:00") for i in range(10)]
        repeats = own[:3] + sent[-2:]  # and two of the batch before
        late = [(999, "2023-12-31 00:00:00")] if batch == 5 else []
        made = spark.createDataFrame(own + repeats + late, "id int, at string").withColumn("at", F.col("at").cast("timestamp"))
        to_messages(made).select("value").coalesce(1).write.mode("append").text(folder)
        messages = read_files(spark, folder, T.StructType().add("value", "string"), fmt="text")
        # the query is started anew for each batch, at an interval
        query = ingest_json_stream(
            messages, TIMED, path, checkpoint, trigger={"processingTime": "1 second"}, once=(["id"], "at", "90 minutes")
        )
        metrics += run_to_idle(query).collect()
        sent += own
    assert rows(spark.read.schema(TIMED).parquet(path), "id") == [(i,) for i in range(60)]
    assert [m.rows for m in metrics] == [13, 15, 15, 15, 15, 16]
    assert max(m.state_rows for m in metrics) <= 40  # not all 60 keys
    assert sum(m.late_rows for m in metrics) == 1


def test_an_interval_takes_two_batches(spark, rows):
    folder, path, checkpoint = (new_folder(spark, n) for n in ("in", "out", "cp"))
    for i in range(2):
        spark.createDataFrame([(f'{{"id":{i}}}',)], "value string").coalesce(1).write.mode("append").text(folder)
    messages = read_files(spark, folder, T.StructType().add("value", "string"), fmt="text", max_files=1)
    query = ingest_json_stream(messages, TIMED, path, checkpoint, trigger={"processingTime": "1 second"})
    assert rows(run_to_idle(query), "rows") == [(1,), (1,)] and not query.isActive
    assert rows(spark.read.schema(TIMED).parquet(path), "id") == [(0,), (1,)]


def test_messages_land_compressed(spark, tables, rows):
    """In files of limited size, as one task reads a compressed file; the stream reads them as they are."""
    plain, folder, path, checkpoint = (new_folder(spark, n) for n in ("plain", "in", "out", "cp"))
    all_rows = tables.read("events").coalesce(1)
    to_messages(all_rows).select("value").write.text(plain)
    write_messages(to_messages(all_rows), folder, per_file=300)
    files = list(Path(folder).glob("part-*"))
    assert len(files) == -(-all_rows.count() // 300) and all(f.suffix == ".gz" for f in files)
    assert 3 * sum(f.stat().st_size for f in files) < sum(f.stat().st_size for f in Path(plain).glob("part-*"))
    messages = read_files(spark, folder, T.StructType().add("value", "string"), fmt="text")
    ingest_json_stream(messages, EVENTS, path, checkpoint, trigger=UNTIL_DONE).awaitTermination()
    assert rows(spark.read.schema(EVENTS).parquet(path)) == rows(all_rows)


def test_feeds_send_compressed_messages(spark):
    made = Path(shared_folder(spark), "lakeops")
    for query, kind in (("daily_feeds", "*-in-*"), ("stream_once", "repeats-landing-*")):
        before = set(made.glob(kind))
        load_all().QUERIES[query](spark, SF_DIR).collect()
        files = [f for d in set(made.glob(kind)) - before for f in d.glob("part-*")]
        assert files and all(f.suffix == ".gz" for f in files)
