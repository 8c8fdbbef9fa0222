"""Analytics queries over box scores: scan, filter, aggregate, window, join."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.text import is_digits
from lakeops.operators import analytics as box_queries
from lakeops.operators.aggregates import (
    pivot_first as first_by_column,
    pivot_mean as mean_by_column,
    range_profile as profile_range,
    run_stats as stats_of_runs,
)
from lakeops.operators.joins import lookup, typed_key_join
from lakeops.operators.quality import null_profile as profile_nulls
from lakeops.operators.windows import carry_forward, rolling_avg as rolling, top_rows
from lakeops.plans.registry import query
from lakeops.plans.views import Tables, adv, box, lines, persons, ratings, sched
from lakeops.sources.bucketed import store_bucketed

# Types in the driver's events, which SQL must name; the queries read them from the data.
EVENT_TYPES = ("click", "error", "purchase", "signup", "view")


@query("SELECT count(*) AS row_count FROM box", ["box"])
def count_all(t: Tables) -> DataFrame:
    return box_queries.count_rows_of(lines(t), persons(t))


@query(
    """SELECT firstname, lastname, playerteamname, points, gameid, linenumber
       FROM box WHERE points >= 30 ORDER BY points DESC, gameid, linenumber""",
    ["box"],
)
def high_scorers(t: Tables) -> DataFrame:
    return box_queries.scoring_leaders(box(t, min_points=30), ["gameid", "linenumber"])


@query(
    """SELECT playerteamname, count(*) AS games_played,
              CAST(ROUND(CAST(AVG(points) AS DECIMAL(18,9)), 2) AS DOUBLE) AS avg_points,
              CAST(ROUND(CAST(AVG(assists) AS DECIMAL(18,9)), 2) AS DOUBLE) AS avg_assists,
              CAST(ROUND(CAST(AVG(reboundsdefensive + reboundsoffensive) AS DECIMAL(18,9)), 2)
                   AS DOUBLE) AS avg_rebounds
       FROM box GROUP BY playerteamname ORDER BY avg_points DESC, playerteamname""",
    ["box"],
)
def team_averages(t: Tables) -> DataFrame:
    return box_queries.team_averages_of(lines(t), persons(t))


def _events_with_k(t: Tables) -> DataFrame:
    return t.read("events").withColumn("k_text", F.get_json_object("props", "$.k"))


@query(
    """SELECT event_id, user_id, ts, k,
              CAST(ROUND(CAST(AVG(k) OVER (PARTITION BY user_id ORDER BY ts, event_id
                   ROWS BETWEEN 4 PRECEDING AND CURRENT ROW) AS DECIMAL(18,9)), 2) AS DOUBLE)
                   AS rolling_avg_5games
       FROM (SELECT event_id, user_id, ts,
                    CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events) e"""
)
def rolling_avg(t: Tables) -> DataFrame:
    rows = _events_with_k(t).select(
        "event_id", "user_id", "ts", F.col("k_text").cast("int").alias("k")
    )
    return rolling(
        rows,
        ["user_id"],
        ["ts", "event_id"],
        "k",
        "rolling_avg_5games",
        sizes_from=t.read("events"),
    )


@query(
    """SELECT p.firstname, p.lastname, p.points, p.assists, s.arenaname, s.arenacity, s.gamelabel,
              p.gameid, p.linenumber, p.gamedatetimeest, p.personid, p.price
       FROM box p JOIN sched s ON p.gameid = s.gameid WHERE p.points > 20
       ORDER BY p.points DESC, p.gameid, p.linenumber, p.gamedatetimeest, p.personid, p.price
       LIMIT 500""",
    ["box", "sched"],
)
def join_schedule(t: Tables) -> DataFrame:
    ties = ["gameid", "linenumber", "gamedatetimeest", "personid", "price"]
    return box_queries.with_schedule(box(t, min_points=21), sched(t), ties)


@query(
    """SELECT p.personid, p.firstname, p.lastname, p.points, a.tspct, a.pie, a.netrating, a.usgpct,
              p.gameid, p.linenumber, p.gamedatetimeest, p.price
       FROM box p JOIN adv a ON p.personid = a.personid AND CAST(p.gameid AS VARCHAR) = a.gameid
       ORDER BY p.personid, p.gameid, p.linenumber, p.gamedatetimeest, p.price
       LIMIT 1000""",
    ["box", "adv"],
)
def join_advanced(t: Tables) -> DataFrame:
    """Both sides have typed ids, so that lines and ratings meet where they were grouped."""
    ties = ["gameid", "linenumber", "gamedatetimeest", "price"]
    return box_queries.with_advanced(box(t), ratings(t), ties)


@query(
    """SELECT p.personid, p.points, a.tspct, a.pie, p.gameid, p.linenumber, p.gamedatetimeest, p.price
       FROM box p JOIN adv a ON p.personid = a.personid AND CAST(p.gameid AS VARCHAR) = a.gameid
       WHERE p.points >= 45""",
    ["box", "adv"],
)
def join_mixed_types(t: Tables) -> DataFrame:
    """The game id is a number on one side and text on the other."""
    best = box(t, min_points=45)
    joined = typed_key_join(best, adv(t), {"personid": "bigint", "gameid": "bigint"})
    return joined.select(
        "personid", "points", "tspct", "pie", "gameid", "linenumber", "gamedatetimeest", "price"
    )


@query(
    """SELECT p.firstname, p.lastname, p.points, p.assists, a.tspct, a.pie, s.arenaname, s.arenacity,
              p.gameid, p.linenumber, p.gamedatetimeest, p.personid, p.price
       FROM box p JOIN adv a ON p.personid = a.personid AND CAST(p.gameid AS VARCHAR) = a.gameid
       JOIN sched s ON p.gameid = s.gameid WHERE p.points >= 25
       ORDER BY p.points DESC, p.gameid, p.linenumber, p.gamedatetimeest, p.personid, p.price
       LIMIT 200""",
    ["box", "adv", "sched"],
)
def join_three_way(t: Tables) -> DataFrame:
    ties = ["gameid", "linenumber", "gamedatetimeest", "personid", "price"]
    return box_queries.with_advanced_and_schedule(box(t, min_points=25), ratings(t), sched(t), ties)


@dataclass(frozen=True)
class BucketedTables(Tables):
    """Lines and orders as tables bucketed by the order."""

    copies: dict = field(default_factory=dict)

    def read(self, name: str) -> DataFrame:
        key = {"lineitem": "l_orderkey", "orders": "o_orderkey"}.get(name)
        if key is None:
            return super().read(name)
        if name not in self.copies:
            self.copies[name] = store_bucketed(super().read(name), [key], name=name)
        return self.copies[name]


@query(
    """SELECT p.personid, p.points, p.assists, a.tspct, a.pie, a.netrating, s.arenaname, s.arenacity, s.gamelabel,
              p.gameid, p.linenumber, p.gamedatetimeest, p.price
       FROM box p JOIN adv a ON p.personid = a.personid AND CAST(p.gameid AS VARCHAR) = a.gameid
       JOIN sched s ON p.gameid = s.gameid
       ORDER BY p.points DESC, p.gameid, p.linenumber, p.gamedatetimeest, p.personid, p.price
       LIMIT 1000""",
    ["box", "adv", "sched"],
)
def join_bucketed(t: Tables) -> DataFrame:
    """All lines with ratings and schedule, from tables that need no exchange for it.

    Stored by the order once, lines are grouped into ratings and joined to them and to the
    schedule where they lie.
    """
    return bucketed_three_way(BucketedTables(t.spark, t.sf_dir))


def bucketed_three_way(t: Tables) -> DataFrame:
    ties = ["gameid", "linenumber", "gamedatetimeest", "personid", "price"]
    line, rating = lines(t), ratings(t).withColumnsRenamed({"personid": "rated", "gameid": "rated_in"})
    # the game alone is the join key, as both sides lie by it; a game has few persons
    same = (line["gameid"] == rating["rated_in"]) & line["personid"].between(rating["rated"], rating["rated"])
    rated = line.join(rating, same).drop("rated", "rated_in")
    joined = typed_key_join(rated, sched(t), {"gameid": "bigint"})
    top = top_rows(joined, [F.col("points").desc(), *ties], 1000)
    return top.select(
        "personid", "points", "assists", "tspct", "pie", "netrating", "arenaname", "arenacity", "gamelabel",
        "gameid", "linenumber", "gamedatetimeest", "price",
    )


def _pct(part: str, whole: str) -> str:
    return (
        f"CAST(ROUND(CAST(CAST({part} AS DOUBLE) / NULLIF(CAST({whole} AS DOUBLE), 0)"
        " * 100 AS DECIMAL(18,9)), 2) AS DOUBLE)"
    )


@query(
    f"""WITH sums AS (SELECT playerteamname AS team, SUM(fieldgoalsmade) AS f1, SUM(fieldgoalsattempted) AS f2,
                             SUM(threepointersmade) AS t1, SUM(threepointersattempted) AS t2,
                             SUM(freethrowsmade) AS s1, SUM(freethrowsattempted) AS s2,
                             COUNT(DISTINCT personid) AS people
                      FROM box GROUP BY playerteamname)
        SELECT team AS playerteamname, {_pct('f1', 'f2')} AS fg_pct, {_pct('t1', 't2')} AS three_pct,
               {_pct('s1', 's2')} AS ft_pct, people AS players_used
        FROM sums ORDER BY fg_pct DESC, playerteamname""",
    ["box"],
)
def shooting_efficiency(t: Tables) -> DataFrame:
    return box_queries.shooting_efficiency_of(lines(t), persons(t))


@query(
    """WITH totals AS (SELECT personid, SUM(points) AS scored FROM box GROUP BY personid),
            named AS (SELECT DISTINCT personid, playerteamname, firstname, lastname FROM box),
            shown AS (SELECT n.playerteamname, n.firstname, n.lastname,
                             CAST(SUM(t.scored) AS BIGINT) AS total_points
                      FROM totals t JOIN named n USING (personid) GROUP BY 1, 2, 3),
            most AS (SELECT playerteamname, MAX(total_points) AS total_points FROM shown GROUP BY 1)
       SELECT shown.*, CAST(1 AS BIGINT) AS rnk
       FROM shown JOIN most USING (playerteamname, total_points)
       ORDER BY total_points DESC, playerteamname, lastname, firstname""",
    ["box"],
)
def top_per_group(t: Tables) -> DataFrame:
    return box_queries.top_scorers_of(lines(t), persons(t))


@query(
    """SELECT playername, teamname, tspct, pie, netrating, offrating, defrating, usgpct, personid, gameid
       FROM adv
       WHERE tspct > 0.6 AND usgpct > 0.25 AND pie > 0.15
       ORDER BY pie DESC, personid, gameid LIMIT 100""",
    ["adv"],
)
def efficient_filter(t: Tables) -> DataFrame:
    return box_queries.efficient_players(adv(t))


_SCORES_SQL = """
    SELECT event_id, user_id, ts, event_type,
           COALESCE(LAST_VALUE(CASE WHEN event_type = 'purchase' AND regexp_matches(k_text, '^[0-9]+$')
                               THEN k_text END IGNORE NULLS)
                    OVER (PARTITION BY user_id ORDER BY ts, event_id
                          ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '0') AS running_score
    FROM (SELECT *, json_extract_string(props, '$.k') AS k_text FROM events) e"""


@query(_SCORES_SQL)
def running_score(t: Tables) -> DataFrame:
    """Score text of the last purchase so far, per user in time order."""
    valid = (F.col("event_type") == "purchase") & is_digits("k_text")
    scored = carry_forward(
        _events_with_k(t).select("event_id", "user_id", "ts", "event_type", "k_text"),
        ["user_id"],
        ["ts", "event_id"],
        F.col("k_text"),
        valid,
        "running_score",
        "0",
        sizes_from=t.read("events"),
    )
    return scored.drop("k_text")


@query(
    f"""WITH scores AS ({_SCORES_SQL})
        SELECT e.event_id, e.user_id, COALESCE(s.running_score, '0 - 0') AS running_score
        FROM events e LEFT JOIN (SELECT * FROM scores WHERE event_type <> 'error') s
          ON e.user_id = s.user_id AND e.event_id = s.event_id"""
)
def score_lookup(t: Tables) -> DataFrame:
    """Score at each event, looked up by (user, event); errors have no score of their own."""
    scores = running_score(t).where(F.col("event_type") != "error")
    rows = t.read("events").select("event_id", "user_id")
    return lookup(rows, scores, ["user_id", "event_id"], "running_score", "0 - 0")


@query(
    """SELECT count(*) AS total_rows, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date,
              COUNT(DISTINCT substr(CAST(o_orderdate AS VARCHAR), 1, 4)) AS unique_years
       FROM orders"""
)
def range_profile(t: Tables) -> DataFrame:
    return profile_range(t.read("orders"), "o_orderdate")


@query(
    """SELECT event_type, user_id, COUNT(value) AS runs,
              CAST(ROUND(CAST(AVG(value) AS DECIMAL(18,9)), 2) AS DOUBLE) AS avg_value,
              CAST(ROUND(CAST(MIN(value) AS DECIMAL(18,9)), 2) AS DOUBLE) AS min_value,
              CAST(ROUND(CAST(MAX(value) AS DECIMAL(18,9)), 2) AS DOUBLE) AS max_value,
              CAST(ROUND(CAST(COALESCE(STDDEV_SAMP(value), 0) AS DECIMAL(18,9)), 2) AS DOUBLE)
                   AS stddev_value
       FROM events GROUP BY event_type, user_id"""
)
def run_stats(t: Tables) -> DataFrame:
    return stats_of_runs(t.read("events"), ["event_type", "user_id"], "value")


def _pivot_sql(cell: str) -> str:
    cells = ", ".join(
        f"{cell.format(case=f'CASE WHEN event_type = {chr(39)}{e}{chr(39)} THEN value END', e=e)} AS {e}"
        for e in EVENT_TYPES
    )
    return f"SELECT user_id, {cells} FROM events GROUP BY user_id"


@query(_pivot_sql("min_by(value, event_id) FILTER (WHERE event_type = '{e}')"))
def pivot_first(t: Tables) -> DataFrame:
    return first_by_column(t.read("events"), ["user_id"], "event_type", "value", "event_id")


@query(_pivot_sql("CAST(ROUND(CAST(AVG({case}) AS DECIMAL(18,9)), 2) AS DOUBLE)"))
def pivot_mean(t: Tables) -> DataFrame:
    return mean_by_column(t.read("events"), ["user_id"], "event_type", "value")


@query(
    """WITH e AS (SELECT CASE WHEN event_type = 'error' THEN NULL ELSE value END AS points,
                         CASE WHEN event_type = 'signup' THEN NULL ELSE user_id END AS reboundsdefensive,
                         CASE WHEN event_type IN ('signup', 'view') THEN NULL ELSE user_id END
                              AS reboundsoffensive
                  FROM events),
          n AS (SELECT count(*) AS total,
                       count(*) FILTER (WHERE points IS NULL) AS a,
                       count(*) FILTER (WHERE reboundsoffensive IS NULL) AS b,
                       count(*) FILTER (WHERE reboundsdefensive IS NULL AND reboundsoffensive IS NULL) AS c
                FROM e)
       SELECT u.column_name, u.null_count,
              CAST(ROUND(CAST(u.null_count / NULLIF(CAST(n.total AS DOUBLE), 0) * 100
                   AS DECIMAL(18,9)), 2) AS DOUBLE) AS null_pct
       FROM n, (SELECT 'points' AS column_name, a AS null_count FROM n
                UNION ALL SELECT 'reboundsoffensive', b FROM n
                UNION ALL SELECT 'rebounds_total', c FROM n) u"""
)
def null_profile(t: Tables) -> DataFrame:
    kind = F.col("event_type")
    rows = t.read("events").select(
        F.when(kind != "error", F.col("value")).alias("points"),
        F.when(kind != "signup", F.col("user_id")).alias("reboundsdefensive"),
        F.when(~kind.isin("signup", "view"), F.col("user_id")).alias("reboundsoffensive"),
    )
    offensive, defensive = F.col("reboundsoffensive"), F.col("reboundsdefensive")
    return profile_nulls(
        rows,
        {
            "points": F.col("points").isNull(),
            "reboundsoffensive": offensive.isNull(),
            "rebounds_total": defensive.isNull() & offensive.isNull(),
        },
    )
