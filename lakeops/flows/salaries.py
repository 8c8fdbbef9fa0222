"""Salaries: file to landing, names to ids, later seasons added to the table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops import schemas
from lakeops.flows.tables import BOX, SALARIES, SALARIES_RAW
from lakeops.functions.numbers import lenient_double, lenient_long
from lakeops.functions.text import after_first_token, first_token
from lakeops.operators.aggregates import unpivot_positive
from lakeops.operators.dedupe import first_per_key
from lakeops.operators.history import add_columns
from lakeops.operators.merge import update_matched
from lakeops.operators.quality import coverage
from lakeops.operators.similarity import BlockRatio, best_match
from lakeops.sources.files import csv_options, write_table
from lakeops.sources.layers import Lake

# Columns added for later seasons and the file columns they come from.
LATER_SEASONS = {f"salary_{s.replace('-', '_')}": s for s in schemas.SALARY_SEASONS[1:5]}


def land_salaries(spark: SparkSession, lake: Lake, csv_path: str) -> None:
    """Replace the raw salary table by a file with a player, a team and season columns."""
    text = spark.read.options(**csv_options(False)).option("inferSchema", "false").csv(csv_path)
    rows = text.select(
        F.trim("player").alias("fullname"),
        F.col("team").alias("playerteamName"),
        *[lenient_double(F.col(f"`{s}`")).alias(s) for s in schemas.SALARY_SEASONS],
    )
    write_table(rows, lake.path("landing", SALARIES_RAW), mode="overwrite")


def process_salaries(spark: SparkSession, lake: Lake, wide: DataFrame) -> DataFrame:
    """Wide salaries to one row per player and season, with the id of the best matching name.

    Seasons in the input are replaced, others are kept. Returns the coverage of the match.
    """
    seasons = {s: s for s in schemas.SALARY_SEASONS if s in wide.columns}
    long = unpivot_positive(wide, ["fullname", "playerteamName"], seasons, "season", "salary_usd")
    landed = lake.read(spark, "landing", BOX, schemas.BOX_SCORE_LANDING)
    registry = landed.select(
        lenient_long("personId").alias("personid"),
        F.concat(F.trim("firstName"), F.lit(" "), F.trim("lastName")).alias("registered"),
    ).distinct()
    matched = best_match(long, registry, "fullname", "registered", "personid", BlockRatio())
    found = F.col("match_id").isNotNull()
    rows = matched.where(found).select(
        F.col("match_id").alias("personid"),
        F.col("fullname").alias("player_name"),
        "playerteamName",
        F.col("salary_usd").cast("bigint").alias("salary_usd"),
        "season",
    )
    write_table(
        rows, lake.path("processed", SALARIES), mode="overwrite", partition_by=["season"], dynamic=True
    )
    return coverage(matched, found, F.col("match_score"))


def add_later_seasons(table: DataFrame, wide: DataFrame, order: Sequence[str]) -> DataFrame:
    """``table`` (with firstname, lastname) plus later seasons from the wide salaries.

    Names are compared without case; the first row in ``order`` wins when a name occurs
    twice, and names of one word are left out. Players without a match have NULL.
    """
    named = wide.where(F.trim("fullname").contains(" ")).withColumns(
        {"fn": first_token(F.trim("fullname")), "ln": after_first_token(F.trim("fullname"))}
    )
    source = first_per_key(named, [F.lower("fn"), F.lower("ln")], order)
    wider = add_columns(table, {c: "double" for c in LATER_SEASONS})
    return update_matched(wider, source, {"firstname": "fn", "lastname": "ln"}, LATER_SEASONS)
