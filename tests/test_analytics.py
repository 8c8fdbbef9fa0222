"""The box-score queries on rows in the tables' own format."""

from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import types as T

from lakeops import schemas
from lakeops.operators import analytics

ZERO = {T.IntegerType(): 0, T.LongType(): 0, T.BooleanType(): False, T.StringType(): "x"}


def row(person, game, team, **values):
    base = {f.name: ZERO.get(f.dataType) for f in schemas.BOX_SCORE_PROCESSED.fields}
    base |= dict(
        personId=person, gameId=game, playerteamName=team, firstName="F", lastName=f"L{person}",
        gameDateTimeEst=dt.datetime(2025, 10, 20) + dt.timedelta(days=game), **values,
    )
    return tuple(base[f.name] for f in schemas.BOX_SCORE_PROCESSED.fields)


@pytest.fixture(scope="module")
def box(spark):
    rows = [
        row(1, 10, "A", points=40, assists=1, reboundsDefensive=4, reboundsOffensive=1, fieldGoalsMade=1, fieldGoalsAttempted=3),
        row(1, 11, "A", points=10, assists=2, reboundsDefensive=None, reboundsOffensive=1, fieldGoalsMade=1, fieldGoalsAttempted=3),
        row(2, 10, "A", points=50, assists=4, reboundsDefensive=2, reboundsOffensive=2),
        row(3, 10, None, points=30),
        row(4, 11, "B", points=25),
    ]
    # a namesake of player 3 in the same team
    namesake = list(row(5, 11, None, points=31))
    namesake[1] = "L3"
    return spark.createDataFrame([*rows, tuple(namesake)], schemas.BOX_SCORE_PROCESSED)


@pytest.fixture(scope="module")
def schedule(spark):
    return spark.createDataFrame([(10, "Ar", "Ci", "Cup"), (12, "Br", "Di", None)], "gameid int, arenaname string, arenacity string, gamelabel string")


@pytest.fixture(scope="module")
def advanced(spark):
    columns = "personid int, gameid string, playername string, teamname string, tspct double, pie double, netrating double, offrating double, defrating double, usgpct double"
    return spark.createDataFrame(
        [
            (1, "10", "F L1", "A", 0.7, 0.2, 1.0, 2.0, 1.0, 0.3),
            (2, "10", "F L2", "A", 0.6, 0.9, 1.0, 2.0, 1.0, 0.3),
            (4, "bad", "F L4", "B", 0.9, 0.3, 1.0, 2.0, 1.0, 0.3),
            (9, "11", "F L9", "B", None, 0.3, 1.0, 2.0, 1.0, 0.3),
        ],
        columns,
    )


def test_leaders(box):
    assert [r.points for r in analytics.scoring_leaders(box).collect()] == [50, 40, 31, 30]


def test_team_averages(box, rows):
    assert rows(analytics.team_averages(box), "playerteamname", "games_played", "avg_points", "avg_rebounds") == [
        (None, 2, 30.5, 0.0), ("A", 3, 33.33, 4.5), ("B", 1, 25.0, 0.0),
    ]


def test_rolling(box, rows):
    assert rows(analytics.rolling_points(box).where("personid = 1"), "gameid", "rolling_avg_5games") == [(10, 40.0), (11, 25.0)]


def test_shooting(box, rows):
    assert rows(analytics.shooting_efficiency(box), "playerteamname", "fg_pct", "ft_pct", "players_used") == [
        (None, None, None, 2), ("A", 33.33, None, 2), ("B", None, None, 1),
    ]


def test_top_scorers(box, rows):
    # ties are kept, and players of one name and team are added up
    assert rows(analytics.top_scorers(box), "playerteamname", "lastname", "total_points", "rnk") == [
        (None, "L3", 61, 1), ("A", "L1", 50, 1), ("A", "L2", 50, 1), ("B", "L4", 25, 1),
    ]


def test_joins(box, schedule, advanced):
    assert [(r.personid, r.arenaname) for r in analytics.with_schedule(box, schedule).collect()] == [
        (2, "Ar"), (1, "Ar"), (3, "Ar"),
    ]
    assert [(r.personid, r.gameid, r.pie) for r in analytics.with_advanced(box, advanced).collect()] == [
        (1, 10, 0.2), (2, 10, 0.9),
    ]
    three = analytics.with_advanced_and_schedule(box, advanced, schedule).collect()
    assert [(r.points, r.tspct, r.arenacity) for r in three] == [(50, 0.6, "Ci"), (40, 0.7, "Ci")]


def test_efficient(advanced):
    assert [r.playername for r in analytics.efficient_players(advanced).collect()] == ["F L4", "F L1"]


def test_counts(box):
    assert analytics.count_rows(box).first().row_count == 6
    assert analytics.count_of(box, "playerteamname", "A").first().row_count == 3
    assert analytics.count_of(box, "personid", 99).first().row_count == 0


def test_empty_tables(box, schedule, advanced):
    none = box.limit(0)
    for df in (
        analytics.scoring_leaders(none), analytics.team_averages(none), analytics.rolling_points(none),
        analytics.shooting_efficiency(none), analytics.top_scorers(none),
        analytics.with_advanced_and_schedule(none, advanced, schedule),
    ):
        assert df.count() == 0
