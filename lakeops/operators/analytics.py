"""The analytics queries over box scores, a schedule and advanced statistics.

They take any frame with the columns they name (names are not case sensitive). ``ties`` makes
the order of limited results total; the default is the key of the box-score table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.numbers import ratio_pct, round_to
from lakeops.operators.aggregates import group_averages, group_ratios
from lakeops.operators.joins import typed_key_join
from lakeops.operators.windows import rolling_avg, top_per_group, top_rows

# Limits of the queries.
LEADER_POINTS, SCHEDULE_POINTS, THREE_WAY_POINTS = 30, 20, 25
SCHEDULE_ROWS, ADVANCED_ROWS, EFFICIENT_ROWS, THREE_WAY_ROWS = 500, 1000, 100, 200
MIN_TSPCT, MIN_USGPCT, MIN_PIE = 0.6, 0.25, 0.15

BOX_KEY = ("gameid", "personid")
_ARENA = ("gameid", "arenaname", "arenacity", "gamelabel")
_RATINGS = ("personid", "gameid", "tspct", "pie", "netrating", "usgpct")
_ID_TYPES = {"personid": "bigint", "gameid": "bigint"}


def count_rows(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("row_count"))


def scoring_leaders(box: DataFrame, ties: Sequence[str] = BOX_KEY) -> DataFrame:
    """Rows of at least 30 points, best first."""
    rows = box.where(F.col("points") >= LEADER_POINTS)
    return rows.orderBy(F.col("points").desc(), *ties).select(
        "firstname", "lastname", "playerteamname", "points", *ties
    )


def team_averages(box: DataFrame) -> DataFrame:
    """Games and means per team; a row without both rebound counts is left out of their mean."""
    means = {
        "avg_points": F.col("points"),
        "avg_assists": F.col("assists"),
        "avg_rebounds": F.col("reboundsdefensive") + F.col("reboundsoffensive"),
    }
    report = group_averages(box, ["playerteamname"], means, "games_played")
    return report.orderBy(F.col("avg_points").desc(), "playerteamname")


def rolling_points(box: DataFrame, **limits) -> DataFrame:
    """Mean points of a player's last five games, at each game."""
    rows = box.select("firstname", "lastname", "personid", "gameid", "gamedatetimeest", "points")
    return rolling_avg(
        rows, ["personid"], ["gamedatetimeest", "gameid"], "points", "rolling_avg_5games", **limits
    )


def with_schedule(box: DataFrame, schedule: DataFrame, ties: Sequence[str] = BOX_KEY) -> DataFrame:
    """Top rows above 20 points with their arena."""
    rows = box.where(F.col("points") > SCHEDULE_POINTS).drop("gamelabel")
    joined = typed_key_join(rows, schedule.select(*_ARENA), {"gameid": "bigint"})
    top = top_rows(joined, [F.col("points").desc(), *ties], SCHEDULE_ROWS)
    return top.select(
        "firstname", "lastname", "points", "assists", "arenaname", "arenacity", "gamelabel", *ties
    )


def with_advanced(box: DataFrame, advanced: DataFrame, ties: Sequence[str] = BOX_KEY) -> DataFrame:
    """First rows with their advanced statistics; ids may be text on one side."""
    joined = typed_key_join(box, advanced.select(*_RATINGS), _ID_TYPES)
    top = top_rows(joined, ["personid", *ties], ADVANCED_ROWS)
    others = [c for c in ties if c != "personid"]
    return top.select(
        "personid", "firstname", "lastname", "points", "tspct", "pie", "netrating", "usgpct", *others
    )


def with_advanced_and_schedule(
    box: DataFrame, advanced: DataFrame, schedule: DataFrame, ties: Sequence[str] = BOX_KEY
) -> DataFrame:
    """Top rows of at least 25 points with advanced statistics and arena."""
    rows = box.where(F.col("points") >= THREE_WAY_POINTS).drop("gamelabel")
    rated = typed_key_join(rows, advanced.select(*_RATINGS), _ID_TYPES)
    joined = typed_key_join(rated, schedule.select(*_ARENA), {"gameid": "bigint"})
    top = top_rows(joined, [F.col("points").desc(), *ties], THREE_WAY_ROWS)
    return top.select(
        "firstname", "lastname", "points", "assists", "tspct", "pie", "arenaname", "arenacity", *ties
    )


def shooting_efficiency(box: DataFrame) -> DataFrame:
    """Shooting percentages of sums per team (NULL without attempts) and players used."""
    ratios = {
        "fg_pct": ("fieldgoalsmade", "fieldgoalsattempted"),
        "three_pct": ("threepointersmade", "threepointersattempted"),
        "ft_pct": ("freethrowsmade", "freethrowsattempted"),
    }
    report = group_ratios(box, ["playerteamname"], ratios, {"players_used": "personid"})
    return report.orderBy(F.col("fg_pct").desc(), "playerteamname")


def top_scorers(box: DataFrame) -> DataFrame:
    """Best scorer per team by total points; ties are kept, players of one name are added up."""
    totals = box.groupBy("playerteamname", "firstname", "lastname").agg(
        F.sum("points").alias("total_points")
    )
    best = top_per_group(totals, ["playerteamname"], "total_points")
    return best.orderBy(F.col("total_points").desc(), "playerteamname", "lastname", "firstname")


def efficient_players(
    advanced: DataFrame, ties: Sequence[str] = ("personid", "gameid")
) -> DataFrame:
    """Top rows by impact among those with high shooting, usage and impact."""
    wanted = (
        (F.col("tspct") > MIN_TSPCT) & (F.col("usgpct") > MIN_USGPCT) & (F.col("pie") > MIN_PIE)
    )
    top = top_rows(advanced.where(wanted), [F.col("pie").desc(), *ties], EFFICIENT_ROWS)
    return top.select(
        "playername", "teamname", "tspct", "pie", "netrating", "offrating", "defrating", "usgpct", *ties
    )


def count_of(df: DataFrame, column: str, value) -> DataFrame:
    """Rows with one value of a column; files without it are skipped by their statistics."""
    return count_rows(df.where(F.col(column) == value))


# The same reports where names and teams are in a table of persons, one row each: lines are
# grouped by person first, so that only sums and counts are shuffled and joined.


def _per_person(lines: DataFrame, persons: DataFrame, *sums) -> DataFrame:
    return lines.groupBy("personid").agg(*sums).join(persons, "personid")


def count_rows_of(lines: DataFrame, persons: DataFrame) -> DataFrame:
    """Lines that have a person."""
    counts = _per_person(lines, persons.select("personid"), F.count("*").alias("n"))
    return counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("row_count"))


def team_averages_of(lines: DataFrame, persons: DataFrame) -> DataFrame:
    """``team_averages`` from sums and counts by person."""
    values = {
        "avg_points": F.col("points"),
        "avg_assists": F.col("assists"),
        "avg_rebounds": F.col("reboundsdefensive") + F.col("reboundsoffensive"),
    }
    parts = [
        f(v).alias(f"{name}_{kind}")
        for name, v in values.items()
        for f, kind in ((F.sum, "sum"), (F.count, "n"))
    ]
    rows = _per_person(lines, persons, F.count("*").alias("n"), *parts)
    means = [
        round_to(F.sum(f"{name}_sum") / F.nullif(F.sum(f"{name}_n"), F.lit(0))).alias(name)
        for name in values
    ]
    report = rows.groupBy("playerteamname").agg(F.sum("n").alias("games_played"), *means)
    return report.orderBy(F.col("avg_points").desc(), "playerteamname")


def shooting_efficiency_of(lines: DataFrame, persons: DataFrame) -> DataFrame:
    """``shooting_efficiency`` from sums by person; each person is one player used."""
    ratios = {"fg_pct": "fieldgoals", "three_pct": "threepointers", "ft_pct": "freethrows"}
    sums = [
        F.sum(f"{column}{part}").alias(f"{column}{part}")
        for column in ratios.values()
        for part in ("made", "attempted")
    ]
    rows = _per_person(lines, persons, *sums)
    pcts = [ratio_pct(f"{c}made", f"{c}attempted").alias(name) for name, c in ratios.items()]
    report = rows.groupBy("playerteamname").agg(*pcts, F.count("*").alias("players_used"))
    return report.orderBy(F.col("fg_pct").desc(), "playerteamname")


def top_scorers_of(lines: DataFrame, persons: DataFrame) -> DataFrame:
    """``top_scorers`` from sums by person; persons of one name and team are added up."""
    return top_scorers(_per_person(lines, persons, F.sum("points").alias("points")))
