"""Box scores: feed to landing, landing to processed, processed to warehouse."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops import schemas
from lakeops.flows.tables import BOX, BOX_MONTHLY, SALARIES
from lakeops.functions.dates import month_start
from lakeops.functions.text import normalize_id, to_messages, typed_defaults
from lakeops.operators import marts
from lakeops.operators.dedupe import latest_per_key, with_cast_keys
from lakeops.operators.incremental import incremental_rows
from lakeops.operators.merge import upsert_table
from lakeops.operators.quality import assert_unique, null_profile, require_non_empty
from lakeops.sources.files import read_csv_lenient, write_table
from lakeops.sources.layers import Lake
from lakeops.sources.published import publish
from lakeops.streaming.ingest import ingest_json_stream

# First day of the second size tier, write order inside the files of a tier.
RECENT_TIER_START = "2015-10-01"
TIER_TABLES = {"players_500k": RECENT_TIER_START, "players_full": None}


def box_score_messages(spark: SparkSession, lake: Lake, csv_path: str) -> DataFrame:
    """Messages for the box scores that are newer than the landing table, oldest first."""
    feed = read_csv_lenient(spark, csv_path, schemas.BOX_SCORE_LANDING, schemas.BOX_SCORE_FILE_NAMES)
    landed = lake.read(spark, "landing", BOX, schemas.BOX_SCORE_LANDING)
    new = incremental_rows(feed, landed, "gameDateTimeEst", ["gameId", "personId"])
    clean = new.withColumns({c: normalize_id(c) for c in ("personId", "gameId")})
    return to_messages(typed_defaults(clean), key="gameId")


def land_box_scores(
    messages: DataFrame, lake: Lake, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start appending a stream of box-score messages to the landing table."""
    return ingest_json_stream(
        messages, schemas.BOX_SCORE_LANDING, lake.path("landing", BOX), checkpoint, trigger=trigger
    )


def merge_box_scores(spark: SparkSession, lake: Lake) -> list:
    """Merge the landed box scores into the processed table; returns the rewritten months."""
    landed = lake.read(spark, "landing", BOX, schemas.BOX_SCORE_LANDING)
    require_non_empty(landed, "landing table")
    typed = with_cast_keys(landed, {"personId": "bigint", "gameId": "bigint"}).withColumns(
        {"win": F.col("win").cast("boolean"), "home": F.col("home").cast("boolean")}
    )
    names = schemas.BOX_SCORE_PROCESSED.fieldNames()
    # the other columns only order rows of the same moment
    rest = [c for c in names if c not in ("gameDateTimeEst", "gameId", "personId")]
    latest = latest_per_key(typed, ["gameId", "personId"], ["gameDateTimeEst", *rest])
    return upsert_table(
        spark,
        lake.path("processed", BOX),
        BOX_MONTHLY,
        latest.withColumn("month", month_start("gameDateTimeEst")),
        ["gameId", "personId"],
        "month",
        sort_by=[F.col("playerteamName"), F.col("gameId").desc()],
        check_unique=False,
    )


def refresh_warehouse(spark: SparkSession, lake: Lake) -> None:
    """Rebuild the marts from the processed tables.

    Each is written aside and published once it has rows and unique keys; until then, and if
    the refresh fails, readers have the version before.
    """
    games = lake.read(spark, "processed", BOX, BOX_MONTHLY)
    salaries = lake.read(spark, "processed", SALARIES, schemas.SALARY_PROCESSED)
    logs = marts.game_logs(games).select(schemas.GAME_LOGS.fieldNames())
    stats = marts.season_stats(games, salaries).select(schemas.SEASON_STATS.fieldNames())
    publish(
        logs,
        lake.path("warehouse", "game_logs"),
        check=lambda rows: assert_unique(require_non_empty(rows, "game logs"), ["personid", "gameid"]),
        partition_by=["playerteamname"],
        sort_by=[F.col("game_date").desc(), "personid"],
    )
    publish(
        stats,
        lake.path("warehouse", "player_season_stats"),
        check=lambda rows: assert_unique(
            require_non_empty(rows, "season statistics"),
            ["personid", "player_name", "playerteamname", "season_start_year"],
        ),
        partition_by=["season_start_year"],
        sort_by=["playerteamname", F.col("total_points").desc()],
    )


def feed_null_rates(feed: DataFrame) -> DataFrame:
    """Null counts and rates of the feed's main columns; rebounds count when both are missing."""
    names = ("points", "assists", "gameType", "win", "numMinutes")
    tests = {c: F.col(c).isNull() for c in names}
    tests["rebounds_total"] = F.col("reboundsDefensive").isNull() & F.col("reboundsOffensive").isNull()
    return null_profile(feed, tests)


def write_tiers(lake: Lake, feed: DataFrame) -> None:
    """Size tiers of the feed, by month, sorted for skipping inside each file."""
    order = [F.col("playerteamName"), F.col("gameDateTimeEst").desc(), F.col("personId")]
    monthly = feed.withColumn("month", month_start("gameDateTimeEst"))
    for table, start in TIER_TABLES.items():
        first = None if start is None else F.lit(start).cast("timestamp")
        tier = monthly if first is None else monthly.where(F.col("gameDateTimeEst") >= first)
        write_table(
            tier, lake.path("processed", table), mode="overwrite", partition_by=["month"], sort_by=order
        )
