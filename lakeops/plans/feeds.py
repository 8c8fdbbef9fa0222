"""Incremental loads, periods, processing status and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.flows.shots import land_shot_chart, running_scores
from lakeops.functions.dates import next_period as period_after, period
from lakeops.functions.numbers import exact_sum
from lakeops.functions.text import to_messages
from lakeops.operators.incremental import (
    STATUS_SCHEMA,
    append_status,
    current_status,
    incremental_rows as rows_after_mark,
    missing_days as days_without,
    run_record,
)
from lakeops.operators.quality import require_non_empty
from lakeops.plans.registry import query
from lakeops.plans.sales import SALES_SQL
from lakeops.plans.views import SALES_VIEWS, Tables, sales
from lakeops.schemas import DAILY_BOX_DATED_MESSAGE, DAILY_BOX_MESSAGE, DRIVER_TABLES, SHOT_CHART_MESSAGE, SHOT_MESSAGE
from lakeops.sources.files import available_periods as periods_of, read_period, write_sorted, write_table
from lakeops.sources.streams import read_files, write_messages
from lakeops.streaming.ingest import UNTIL_DONE, ingest_json_stream, widen_schema
from lakeops.streaming.upsert import upsert_stream
from lakeops.workspace import new_folder, stored

# The target of the incremental feed was last loaded before this moment.
LOADED_BEFORE = "2024-01-16"

# Users in a partition of the table that keeps the latest event of each user, about.
BUCKET_USERS = 50_000
# Messages of a daily feed in a file, at most.
FILE_MESSAGES = 1_000_000
# Times at which files of events arrive.
ARRIVALS = 4


@query(
    f"""SELECT event_id, ts, user_id, event_type, value FROM events
        WHERE ts > (SELECT MAX(ts) FROM events WHERE ts < TIMESTAMP '{LOADED_BEFORE} 00:00:00')
        ORDER BY ts, event_id"""
)
def incremental_rows(t: Tables) -> DataFrame:
    source = t.read("events").drop("props")
    target = source.where(F.col("ts") < F.lit(LOADED_BEFORE).cast("timestamp_ntz"))
    return rows_after_mark(source, target, "ts", ["event_id"])


@query(
    """WITH loaded AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders
                       WHERE o_orderpriority = '1-URGENT'),
            calendar AS (SELECT CAST(unnest(generate_series(
                            (SELECT MIN(day) + 1 FROM loaded),
                            (SELECT MAX(CAST(o_orderdate AS DATE)) FROM orders),
                            INTERVAL 1 DAY)) AS DATE) AS day)
       SELECT day FROM calendar WHERE day NOT IN (SELECT day FROM loaded) ORDER BY day"""
)
def missing_days(t: Tables) -> DataFrame:
    """Days without an urgent order, up to the last order."""
    orders = t.read("orders")
    urgent = orders.where(F.col("o_orderpriority") == "1-URGENT")
    return days_without(urgent, "o_orderdate", orders, "o_orderdate")


@query(
    """SELECT strftime(MAX(salesdate), '%Y-%m') AS last_period,
              strftime(date_trunc('month', MAX(salesdate)) + INTERVAL 1 MONTH, '%Y-%m') AS next_period
       FROM sales""",
    SALES_VIEWS,
)
def next_period(t: Tables) -> DataFrame:
    last = sales(t).agg(period(F.max("salesdate")).alias("last_period"))
    return last.withColumn("next_period", period_after("last_period"))


def _periods_table(t: Tables) -> DataFrame:
    """Sales stored by year and month."""
    rows = sales(t).withColumns({"year": F.year("salesdate"), "month": F.month("salesdate")})
    path = new_folder(t.spark, "sales-by-month")
    write_table(rows, path, partition_by=["year", "month"])
    return t.spark.read.schema(rows.schema).parquet(path)


@query(
    """SELECT DISTINCT CAST(year(salesdate) AS INT) AS year, CAST(month(salesdate) AS INT) AS month
       FROM sales""",
    SALES_VIEWS,
)
def available_periods(t: Tables) -> DataFrame:
    return periods_of(_periods_table(t))


@query(SALES_SQL + " FROM sales WHERE year(salesdate) = 1998 AND month(salesdate) = 3", SALES_VIEWS)
def partition_period_scan(t: Tables) -> DataFrame:
    return read_period(_periods_table(t), 1998, 3).drop("year", "month")


@query(
    """SELECT CAST(2 AS BIGINT) AS seq, strftime(MAX(salesdate), '%Y-%m') AS last_processed_month,
              count(*) AS total_records_processed, 'success' AS status
       FROM sales""",
    SALES_VIEWS,
)
def processing_status(t: Tables) -> DataFrame:
    """Two runs are recorded, the second on all sales; the newest record is the state."""
    path = new_folder(t.spark, "processing-status")
    rows = sales(t)
    runs = {1: rows.where(F.col("salesdate") < F.lit("1998-01-01").cast("timestamp_ntz")), 2: rows}
    for seq, processed in runs.items():
        record = run_record(
            processed,
            "salesdate",
            seq=seq,
            timestamp=f"2026-01-0{seq}T08:00:00",
            source="landing/sales",
            destination="processed/sales",
            partitions=["year", "month"],
        )
        append_status(path, record.select(STATUS_SCHEMA.fieldNames()))
    return current_status(t.spark, path).select(
        "seq", "last_processed_month", "total_records_processed", "status"
    )


@query(
    """SELECT CAST(year(salesdate) AS INT) AS year, CAST(month(salesdate) AS INT) AS month,
              count(*) AS sales_count, CAST(SUM(totalprice) AS DOUBLE) AS revenue
       FROM sales WHERE strftime(salesdate, '%Y-%m') = '1998-04' GROUP BY 1, 2""",
    SALES_VIEWS,
)
def period_run(t: Tables) -> DataFrame:
    """Two incremental runs: each reads the status, works on the next month alone and records it."""
    table, status = _periods_table(t), new_folder(t.spark, "period-status")
    out = new_folder(t.spark, "period-report")
    before = table.where((F.col("year") == 1998) & (F.col("month") <= 2))
    append_status(status, _record(before, 1))
    for seq in (2, 3):
        last = require_non_empty(current_status(t.spark, status), "processing status")
        wanted = last.select(period_after("last_processed_month").alias("next")).first()["next"]
        rows = read_period(table, *map(int, wanted.split("-")))
        report = rows.groupBy("year", "month").agg(
            F.count("*").alias("sales_count"), exact_sum("totalprice").alias("revenue")
        )
        write_table(report, out, mode="overwrite")
        append_status(status, _record(rows, seq))
    return t.spark.read.parquet(out)


def _record(processed: DataFrame, seq: int) -> DataFrame:
    record = run_record(
        processed,
        "salesdate",
        seq=seq,
        timestamp=f"2026-02-0{seq}T08:00:00",
        source="sales-by-month",
        destination="period-report",
        partitions=["year", "month"],
    )
    return record.select(STATUS_SCHEMA.fieldNames())


def _daily_rows(t: Tables) -> DataFrame:
    """Daily box scores of the first feed, made from lines of orders."""
    whole = F.col("l_quantity").cast("int")
    line = F.col("l_linenumber")
    made = {
        "slug": F.concat(F.lit("p"), F.col("l_suppkey")),
        "name": F.concat(F.lit("Player "), F.col("l_suppkey")),
        "team": F.concat(F.lit("T"), F.col("l_suppkey") % 30),
        "location": F.when(line % 2 == 0, "HOME").otherwise("AWAY"),
        "opponent": F.concat(F.lit("T"), F.col("l_partkey") % 30),
        "outcome": F.when(whole > 25, "WIN").otherwise("LOSS"),
        "seconds_played": whole * 60,
        "points": whole,
        "total_rebounds": line,
        "game_score": (F.col("l_extendedprice") / 8).cast("float"),
        "fecha_partido": F.date_format("l_shipdate", "yyyy-MM-dd"),
    }
    counters = {
        f.name: (whole + i) % 13
        for i, f in enumerate(DAILY_BOX_MESSAGE.fields)
        if f.name not in made
    }
    return t.read("lineitem").select(
        *[(made | counters)[f.name].cast(f.dataType).alias(f.name) for f in DAILY_BOX_MESSAGE.fields],
        F.col("l_orderkey").alias("game"),
        line.cast("int").alias("shot"),
    )


_FEED_SQL = """
    SELECT {name} AS feed, count(*) AS messages, CAST(SUM(CAST(l_quantity AS INT)) * {per} AS BIGINT) AS total,
           COUNT(DISTINCT l_suppkey) AS people
    FROM lineitem"""


@query(
    " UNION ALL ".join(
        _FEED_SQL.format(name=name, per=per) for name, per in (("'daily'", 1), ("'dated'", 60), ("'shots'", 1))
    )
)
def daily_feeds(t: Tables) -> DataFrame:
    """Three feeds of different fields, sent as JSON and landed by streams.

    The total is points, seconds played and points.
    """
    rows = _daily_rows(t)
    shots = rows.select(
        F.col("game").cast("string").alias("GAME_ID"),
        F.col("name").alias("player_name"),
        F.col("shot").alias("SHOT_NUMBER"),
        (F.col("shot") % 4 + 1).alias("PERIOD"),
        (F.col("seconds_played") / 8).alias("SHOT_DIST"),
        F.col("outcome").alias("SHOT_RESULT"),
        F.col("points").alias("PTS"),
    )
    feeds = {
        "daily": (rows.drop("game", "shot"), DAILY_BOX_MESSAGE, "points", "name"),
        "dated": (rows, DAILY_BOX_DATED_MESSAGE, "seconds_played", "name"),
        "shots": (shots, SHOT_MESSAGE, "PTS", "player_name"),
    }
    reports = []
    for feed, (sent, schema, total, person) in feeds.items():
        landing, path, checkpoint = (new_folder(t.spark, f"{feed}-{x}") for x in ("in", "out", "checkpoint"))
        write_messages(to_messages(sent.select(schema.fieldNames())), landing, per_file=FILE_MESSAGES)
        messages = read_files(t.spark, landing, T.StructType().add("value", "string"), fmt="text")
        ingest_json_stream(messages, schema, path, checkpoint, trigger=UNTIL_DONE).awaitTermination()
        landed = t.spark.read.schema(schema).parquet(path)
        reports.append(
            landed.agg(
                F.lit(feed).alias("feed"),
                F.count("*").alias("messages"),
                F.sum(total).alias("total"),
                F.count_distinct(person).alias("people"),
            )
        )
    return reports[0].unionAll(reports[1]).unionAll(reports[2])


@query(
    """WITH actions AS (SELECT user_id, event_id, event_id // 2 AS action,
                               json_extract_string(props, '$.k') AS home,
                               CASE WHEN event_type <> 'error' THEN CAST(event_id % 50 AS VARCHAR) END AS away
                        FROM events),
            carried AS (SELECT user_id, action, event_id,
                               COALESCE(LAST_VALUE(CASE WHEN regexp_matches(home, '^[0-9]+$') AND away IS NOT NULL
                                                        THEN home || ' - ' || away END IGNORE NULLS)
                                        OVER (PARTITION BY user_id ORDER BY event_id
                                              ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '0 - 0') AS score
                        FROM actions),
            scores AS (SELECT user_id, action, arg_max(score, event_id) AS score FROM carried GROUP BY 1, 2)
       SELECT CAST(e.user_id AS VARCHAR) AS id_partido, strftime(e.ts, '%Y-%m-%d') AS fecha_partido,
              CAST(e.event_id % 4 + 1 AS INT) AS cuarto, CAST(e.event_id % 12 AS INT) AS minutos_restantes,
              CAST(e.event_id % 60 AS INT) AS segundos_restantes,
              'H' || CAST(e.user_id % 30 AS VARCHAR) AS equipo_local,
              'V' || CAST(e.user_id % 29 AS VARCHAR) AS equipo_visitante, e.event_type AS equipo_tira,
              'Player ' || CAST(e.user_id AS VARCHAR) AS jugador, CAST(e.event_id % 30 AS INT) AS distancia_pies,
              CASE WHEN e.event_id % 3 = 1 THEN 3 ELSE 2 END AS valor_tiro,
              CASE WHEN e.event_type = 'purchase' THEN 1 ELSE 0 END AS anotado,
              CAST(e.event_id % 500 - 250 AS INT) AS loc_x, CAST(e.event_id % 400 AS INT) AS loc_y,
              COALESCE(s.score, '0 - 0') AS marcador_previo
       FROM events e LEFT JOIN scores s
         ON s.user_id = e.user_id AND s.action = e.event_id // 2 + CASE WHEN e.event_id % 3 = 0 THEN 1 ELSE 0 END"""
)
def shot_feed(t: Tables) -> DataFrame:
    """The shot feed of 15 fields: events as a stream of shots, each with the score carried to it.

    Users stand for games, and two events share an action number; some shots have no action.
    """
    number = F.col("event_id")
    away = F.when(F.col("event_type") != "error", (number % 50).cast("string"))
    actions = t.read("events").select(
        F.col("user_id").alias("GAME_ID"),
        number.alias("position"),
        F.expr("event_id div 2").alias("actionNumber"),
        F.get_json_object("props", "$.k").alias("scoreHome"),
        away.alias("scoreAway"),
    )
    scores = stored(running_scores(actions), "scores")
    events = read_files(t.spark, t.path("events")[:-1] + "[t]", DRIVER_TABLES["events"])
    shots = events.select(
        F.col("user_id").alias("GAME_ID"),
        (F.expr("event_id div 2") + F.when(number % 3 == 0, 1).otherwise(0)).alias("GAME_EVENT_ID"),
        F.date_format("ts", "yyyy-MM-dd").alias("GAME_DATE"),
        (number % 4 + 1).alias("PERIOD"),
        (number % 12).alias("MINUTES_REMAINING"),
        (number % 60).alias("SECONDS_REMAINING"),
        F.concat(F.lit("H"), F.col("user_id") % 30).alias("HTM"),
        F.concat(F.lit("V"), F.col("user_id") % 29).alias("VTM"),
        F.col("event_type").alias("TEAM_NAME"),
        F.concat(F.lit("Player "), F.col("user_id")).alias("PLAYER_NAME"),
        (number % 30).alias("SHOT_DISTANCE"),
        (number % 500 - 250).alias("LOC_X"),
        (number % 400).alias("LOC_Y"),
        F.when(number % 3 == 1, "3PT Field Goal").otherwise("2PT Field Goal").alias("SHOT_TYPE"),
        F.when(F.col("event_type") == "purchase", "Made Shot").otherwise("Missed Shot").alias("EVENT_TYPE"),
    )
    path, checkpoint = new_folder(t.spark, "shot-chart"), new_folder(t.spark, "shot-chart-checkpoint")
    land_shot_chart(shots, scores, path, checkpoint, UNTIL_DONE).awaitTermination()
    return t.spark.read.schema(SHOT_CHART_MESSAGE).parquet(path)


def _stream_folder(t: Tables, arrivals: int = ARRIVALS) -> str:
    """Events as files that arrive one after the other, with late rows and equal times in each.

    An event's arrival follows from its id, so that each covers all users and days.
    """
    path = new_folder(t.spark, "events-landing")
    events = t.read("events")
    for i in range(arrivals):
        part = events.where(F.pmod("event_id", F.lit(arrivals)) == arrivals - 1 - i)
        part.write.mode("append").parquet(path)
    return path


@query(
    """SELECT event_id, ts, user_id, event_type, value,
              CAST(json_extract_string(props, '$.k') AS INT) AS k, CAST(NULL AS VARCHAR) AS device
       FROM events"""
)
def stream_json_ingest(t: Tables) -> DataFrame:
    """Events sent as JSON messages, parsed by a stream and appended; a new field is NULL."""
    # a pattern for this table alone, which may be one file or a folder of files
    events = read_files(t.spark, t.path("events")[:-1] + "[t]", DRIVER_TABLES["events"])
    sent = to_messages(
        events.select(
            "event_id", "ts", "user_id", "event_type", "value",
            F.get_json_object("props", "$.k").cast("int").alias("k"),
        )
    )
    known = T.StructType([f for f in DRIVER_TABLES["events"].fields if f.name != "props"])
    schema = widen_schema(
        known, [T.StructField("k", T.IntegerType()), T.StructField("device", T.StringType())]
    )
    path, checkpoint = new_folder(t.spark, "events"), new_folder(t.spark, "events-checkpoint")
    ingest_json_stream(sent, schema, path, checkpoint, trigger=UNTIL_DONE).awaitTermination()
    return t.spark.read.schema(schema).parquet(path)


@query(
    """SELECT user_id, event_id, ts, event_type, value
       FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
             FROM events) e WHERE rn = 1"""
)
def stream_upsert(t: Tables) -> DataFrame:
    """Latest event per user, kept by merging micro-batches into a table by bucket of users."""
    landing = _stream_folder(t)
    files = t.spark.read.parquet(landing).select(F.input_file_name()).distinct().count()
    users = t.read("events").agg(F.approx_count_distinct("user_id")).first()[0]
    buckets = max(8, users // BUCKET_USERS)
    batch = max(1, files // ARRIVALS)
    events = read_files(t.spark, landing, DRIVER_TABLES["events"], max_files=batch)
    stream = events.select(
        "user_id", "event_id", "ts", "event_type", "value",
        F.pmod(F.xxhash64("user_id"), F.lit(buckets)).cast("int").alias("bucket"),
    )
    path, checkpoint = new_folder(t.spark, "last-event"), new_folder(t.spark, "last-event-checkpoint")
    upsert_stream(
        stream,
        path,
        checkpoint,
        stream.schema,
        ["user_id"],
        ["ts", "event_id"],
        "bucket",
        UNTIL_DONE,
        fixed_partition=True,
    ).awaitTermination()
    return t.spark.read.schema(stream.schema).parquet(path).drop("bucket")


@query("SELECT DISTINCT event_id, ts, user_id, event_type, value FROM events")
def stream_once(t: Tables) -> DataFrame:
    """Events that are sent twice, the second time with the next arrival, and landed once.

    Arrivals come in batches of their own; state is kept for as long as the events reach.
    """
    schema = T.StructType([f for f in DRIVER_TABLES["events"].fields if f.name != "props"])
    events = t.read("events").select(schema.fieldNames())
    landing = new_folder(t.spark, "repeats-landing")
    arrival = F.pmod(F.xxhash64("event_id"), F.lit(ARRIVALS)).cast("int")
    sent = events.withColumn("arrival", F.explode(F.array(arrival, arrival + 1)))
    first, last = sent.agg(F.min("ts"), F.max("ts")).first()
    for i in range(ARRIVALS + 1):
        part = sent.where(F.col("arrival") == i).drop("arrival")
        write_messages(to_messages(part.coalesce(ARRIVALS)), landing, mode="append")
    messages = read_files(t.spark, landing, T.StructType().add("value", "string"), fmt="text", max_files=ARRIVALS)
    path, checkpoint = new_folder(t.spark, "once"), new_folder(t.spark, "once-checkpoint")
    reach = f"{int((last - first).total_seconds()) + 1 if first else 1} seconds"
    ingest_json_stream(
        messages, schema, path, checkpoint, trigger=UNTIL_DONE, once=(["event_id"], "ts", reach)
    ).awaitTermination()
    return t.spark.read.schema(schema).parquet(path)
