"""Names and schemas of the lake's tables."""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from lakeops import schemas
from lakeops.sources.files import ensure_table, read_csv, write_table
from lakeops.sources.layers import Lake

BOX = "box_scores"
SALARIES_RAW = "dim_salaries_raw"
SALARIES = "dim_salaries"

BOX_MONTHLY = T.StructType([*schemas.BOX_SCORE_PROCESSED.fields, T.StructField("month", T.DateType())])


def create_tables(spark: SparkSession, lake: Lake) -> None:
    """Empty tables of the box-score and salary layers; existing tables are kept."""
    ensure_table(spark, lake.path("landing", BOX), schemas.BOX_SCORE_LANDING)
    ensure_table(spark, lake.path("processed", BOX), BOX_MONTHLY, ["month"])
    ensure_table(spark, lake.path("processed", SALARIES), schemas.SALARY_PROCESSED, ["season"])
    ensure_table(spark, lake.path("warehouse", "game_logs"), schemas.GAME_LOGS, ["playerteamname"])
    ensure_table(
        spark, lake.path("warehouse", "player_season_stats"), schemas.SEASON_STATS, ["season_start_year"]
    )


def load_csv_table(
    spark: SparkSession, lake: Lake, csv_path: str, layer: str, table: str, schema: T.StructType | None = None
) -> None:
    """New table from a CSV file with header; an existing table is an error.

    Pass a schema for large files: inferring it reads them twice.
    """
    write_table(read_csv(spark, csv_path, schema), lake.path(layer, table))
