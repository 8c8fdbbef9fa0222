"""Landing to processed to warehouse: dedupe, casts, merges, names, JSON, marts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import lenient_timestamp, month_start
from lakeops.functions.numbers import lenient_double, lenient_flag, lenient_int, lenient_long
from lakeops.functions.text import (
    after_first_token,
    contains_flag,
    equals_flag,
    first_token,
    name_key,
    normalize_id,
    parse_json,
    to_messages,
    typed_defaults,
)
from lakeops.operators import marts
from lakeops.operators.aggregates import unpivot_positive
from lakeops.operators.dedupe import first_per_key, latest_per_key
from lakeops.operators.merge import replace_rows, update_matched, upsert_table
from lakeops.operators.quality import assert_unique, coverage as match_coverage, require_non_empty
from lakeops.operators.similarity import THRESHOLD, BlockRatio, EditSimilarity, best_match
from lakeops.plans.registry import ORACLES, query
from lakeops.plans.views import Tables, box, game_lines, games, persons, salary_wide
from lakeops.sources.files import write_table
from lakeops.sources.published import publish, read_published
from lakeops.workspace import new_folder, stored

_LINE_KEYS = ["l_orderkey", "l_linenumber"]
_LINE_NEWEST = [
    "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount", "l_tax",
    "l_returnflag", "l_linestatus",
]


@query(
    f"""SELECT * EXCLUDE (rn) FROM (SELECT *, ROW_NUMBER() OVER (
             PARTITION BY {', '.join(_LINE_KEYS)}
             ORDER BY {', '.join(c + ' DESC' for c in _LINE_NEWEST)}) AS rn FROM lineitem) l
        WHERE rn = 1"""
)
def dedupe_latest(t: Tables) -> DataFrame:
    return latest_per_key(t.read("lineitem"), _LINE_KEYS, _LINE_NEWEST)


# The processed table holds orders up to this date; the feed brings one row per shipped order.
LOADED_UNTIL = "2000-01-01"

_MERGE_SQL = f"""
    WITH target AS (SELECT o_orderkey AS gameid, o_orderstatus AS status, o_totalprice AS price,
                           o_orderdate AS updated_at
                    FROM orders WHERE o_orderdate < TIMESTAMP '{LOADED_UNTIL} 00:00:00'),
         source AS (SELECT l_orderkey AS gameid, l_linestatus AS status, l_extendedprice AS price,
                           l_shipdate AS updated_at
                    FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY l_orderkey ORDER BY
                             l_shipdate DESC, l_extendedprice DESC, l_linestatus DESC) AS rn
                          FROM lineitem) l WHERE rn = 1)
    SELECT CASE WHEN s.gameid IS NOT NULL THEN s.gameid ELSE t.gameid END AS gameid,
           CASE WHEN s.gameid IS NOT NULL THEN s.status ELSE t.status END AS status,
           CASE WHEN s.gameid IS NOT NULL THEN s.price ELSE t.price END AS price,
           CASE WHEN s.gameid IS NOT NULL THEN s.updated_at ELSE t.updated_at END AS updated_at
    FROM target t FULL OUTER JOIN source s ON t.gameid = s.gameid"""


def _merge_sides(t: Tables) -> tuple[DataFrame, DataFrame]:
    target = (
        t.read("orders")
        .where(F.col("o_orderdate") < F.lit(LOADED_UNTIL).cast("timestamp_ntz"))
        .select(
            F.col("o_orderkey").alias("gameid"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_totalprice").alias("price"),
            F.col("o_orderdate").alias("updated_at"),
        )
    )
    feed = t.read("lineitem").select(
        F.col("l_orderkey").alias("gameid"),
        F.col("l_linestatus").alias("status"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_shipdate").alias("updated_at"),
    )
    return target, latest_per_key(feed, ["gameid"], ["updated_at", "price", "status"])


@query(_MERGE_SQL)
def merge_upsert(t: Tables) -> DataFrame:
    """Orders updated or inserted from the latest line of each order."""
    target, source = _merge_sides(t)
    return replace_rows(target, stored(source, "merge-source"), ["gameid"])


@query(f"SELECT *, CAST(date_trunc('month', updated_at) AS DATE) AS month FROM ({_MERGE_SQL}) m")
def merge_partitions(t: Tables) -> DataFrame:
    """The same merge into a stored table by month; only touched months are rewritten."""
    target, source = _merge_sides(t)
    by_month = target.withColumn("month", month_start("updated_at"))
    path = new_folder(t.spark, "merge-target")
    write_table(by_month, path, partition_by=["month"])
    upsert_table(
        t.spark,
        path,
        by_month.schema,
        source.withColumn("month", month_start("updated_at")),
        ["gameid"],
        "month",
    )
    return t.spark.read.schema(by_month.schema).parquet(path).select(*by_month.columns)


# Rows that are written into the merge itself.
_INLINE_ROWS = "(0, 'renamed', 100), (3, 'also renamed', 300), (77, 'new', 7)"


@query(
    f"""WITH s AS (SELECT * FROM (VALUES {_INLINE_ROWS}) v(n_nationkey, n_name, n_regionkey))
        SELECT n_nationkey, n_name, n_regionkey FROM s
        UNION ALL SELECT n_nationkey, n_name, n_regionkey FROM nation
                  WHERE n_nationkey NOT IN (SELECT n_nationkey FROM s)"""
)
def merge_inline_rows(t: Tables) -> DataFrame:
    """Nations after a merge of rows given in the statement; an empty target is refused."""
    source = t.spark.sql(f"SELECT * FROM VALUES {_INLINE_ROWS} AS s(n_nationkey, n_name, n_regionkey)")
    target = require_non_empty(t.read("nation"), "nation")
    return replace_rows(target, source, ["n_nationkey"])


_UPDATE_SQL = """
    WITH feed AS (SELECT upper(split_part(c.c_name, '#', 1)) AS fn, split_part(c.c_name, '#', 2) AS ln,
                         o.o_totalprice AS price, o.o_orderpriority AS priority, o.o_orderkey
                  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
                  WHERE o.o_orderpriority <> '5-LOW'),
         source AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY lower(fn), lower(ln)
                                   ORDER BY o_orderkey) AS rn FROM feed) f WHERE rn = 1)
    SELECT c.c_custkey, split_part(c.c_name, '#', 1) AS firstname, split_part(c.c_name, '#', 2) AS lastname,
           CASE WHEN s.rn IS NOT NULL THEN s.price ELSE c.c_acctbal END AS balance,
           s.priority AS next_season
    FROM customer c LEFT JOIN source s
      ON lower(split_part(c.c_name, '#', 1)) = lower(s.fn)
     AND lower(split_part(c.c_name, '#', 2)) = lower(s.ln)"""


@query(_UPDATE_SQL)
def merge_update_only(t: Tables) -> DataFrame:
    """Customers updated from the first feed row per name, whatever its case."""

    def part(i: int):
        return F.split_part(F.col("c_name"), F.lit("#"), F.lit(i))

    target = t.read("customer").select(
        "c_custkey",
        part(1).alias("firstname"),
        part(2).alias("lastname"),
        F.col("c_acctbal").alias("balance"),
        F.lit(None).cast("string").alias("next_season"),
    )
    feed = (
        t.read("orders")
        .where(F.col("o_orderpriority") != "5-LOW")
        .join(t.read("customer"), F.col("o_custkey") == F.col("c_custkey"))
        .select(F.upper(part(1)).alias("fn"), part(2).alias("ln"), "o_totalprice", "o_orderpriority", "o_orderkey")
    )
    source = first_per_key(feed, [F.lower("fn"), F.lower("ln")], ["o_orderkey"])
    return update_matched(
        target,
        source,
        {"firstname": "fn", "lastname": "ln"},
        {"balance": "o_totalprice", "next_season": "o_orderpriority"},
    )


# Text columns with good and bad values, derived from every event.
_TEXT_SQL = """
    SELECT event_id, event_type,
           CASE event_type WHEN 'click' THEN concat(CAST(event_id AS VARCHAR), '.0')
                WHEN 'error' THEN concat('x', CAST(event_id AS VARCHAR))
                WHEN 'view' THEN NULL ELSE concat('0', CAST(event_id AS VARCHAR)) END AS id_text,
           CASE event_type WHEN 'view' THEN 'n/a' WHEN 'signup' THEN ''
                ELSE concat(json_extract_string(props, '$.k'), '.0') END AS points_text,
           CASE event_type WHEN 'error' THEN NULL ELSE CAST(value AS VARCHAR) END AS value_text,
           CASE event_type WHEN 'purchase' THEN concat('2024-13-', CAST(day(ts) AS VARCHAR))
                ELSE strftime(ts, '%Y-%m-%d %H:%M:%S') END AS date_text,
           CASE event_type WHEN 'click' THEN '1' WHEN 'view' THEN '0' WHEN 'error' THEN 'maybe'
                ELSE 'true' END AS win_text
    FROM events"""


def _texts(t: Tables) -> DataFrame:
    kind, key = F.col("event_type"), F.col("event_id").cast("string")
    return t.read("events").select(
        "event_id",
        "event_type",
        F.when(kind == "click", F.concat(key, F.lit(".0")))
        .when(kind == "error", F.concat(F.lit("x"), key))
        .when(kind != "view", F.concat(F.lit("0"), key))
        .alias("id_text"),
        F.when(kind == "view", "n/a")
        .when(kind == "signup", "")
        .otherwise(F.concat(F.get_json_object("props", "$.k"), F.lit(".0")))
        .alias("points_text"),
        F.when(kind != "error", F.col("value").cast("string")).alias("value_text"),
        F.when(kind == "purchase", F.concat(F.lit("2024-13-"), F.day("ts").cast("string")))
        .otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .alias("date_text"),
        F.when(kind == "click", "1").when(kind == "view", "0").when(kind == "error", "maybe")
        .otherwise("true")
        .alias("win_text"),
    )


@query(
    f"""WITH texts AS ({_TEXT_SQL})
        SELECT event_id, CAST(trunc(TRY_CAST(id_text AS DOUBLE)) AS BIGINT) AS personid,
               CAST(trunc(TRY_CAST(points_text AS DOUBLE)) AS INT) AS points,
               TRY_CAST(value_text AS DOUBLE) AS value, TRY_CAST(date_text AS TIMESTAMP) AS played_at,
               CASE win_text WHEN '1' THEN true WHEN 'true' THEN true WHEN '0' THEN false END AS win
        FROM texts"""
)
def lenient_cast(t: Tables) -> DataFrame:
    return _texts(t).select(
        "event_id",
        lenient_long("id_text").alias("personid"),
        lenient_int("points_text").alias("points"),
        lenient_double("value_text").alias("value"),
        lenient_timestamp("date_text").alias("played_at"),
        lenient_flag("win_text").alias("win"),
    )


@query(
    f"""WITH texts AS ({_TEXT_SQL})
        SELECT event_id,
               COALESCE(CAST(CAST(trunc(TRY_CAST(id_text AS DOUBLE)) AS BIGINT) AS VARCHAR), id_text, '')
                   AS personid,
               COALESCE(CAST(trunc(TRY_CAST(points_text AS DOUBLE)) AS INT), 0) AS points,
               COALESCE(value_text, '') AS value_text
        FROM texts"""
)
def normalize_ids(t: Tables) -> DataFrame:
    cleaned = _texts(t).select(
        "event_id",
        normalize_id("id_text").alias("personid"),
        lenient_int("points_text").alias("points"),
        "value_text",
    )
    return typed_defaults(cleaned, skip=("event_id",))


@query(
    """SELECT event_id, CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS INT)
              END AS k, event_type = 'error' AS broken FROM events"""
)
def json_parse(t: Tables) -> DataFrame:
    """Message text to typed columns; the text of errors is cut and cannot be read."""
    kind = F.col("event_type")
    text = F.when(kind == "error", F.lit("{bad")).otherwise(F.col("props"))
    whole = F.concat(F.lit('{"event_id": '), F.col("event_id").cast("string"), F.lit("}"))
    # both texts of an event travel in one row, so nothing has to be joined back
    parsed = F.from_json(text, "k int, _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"})
    key = F.from_json(whole, "event_id bigint")
    return t.read("events").select(
        key["event_id"].alias("event_id"),
        parsed["k"].alias("k"),
        parsed["_corrupt"].isNotNull().alias("broken"),
    )


@query(
    """SELECT CAST(o_orderkey AS VARCHAR) AS key,
              CAST(json_object('gameId', CAST(o_orderkey AS VARCHAR), 'personId', CAST(o_custkey AS VARCHAR),
                   'gameType', o_orderstatus, 'gameLabel', o_orderpriority,
                   'gameDateTimeEst', strftime(o_orderdate, '%Y-%m-%d %H:%M:%S'),
                   'win', year(o_orderdate) % 2) AS VARCHAR) AS value
       FROM orders"""
)
def json_encode(t: Tables) -> DataFrame:
    rows = t.read("orders").select(
        F.col("o_orderkey").cast("string").alias("gameId"),
        F.col("o_custkey").cast("string").alias("personId"),
        F.col("o_orderstatus").alias("gameType"),
        F.col("o_orderpriority").alias("gameLabel"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("gameDateTimeEst"),
        (F.year("o_orderdate") % 2).alias("win"),
    )
    return to_messages(rows, key="gameId")


@query(
    """SELECT json_extract_string(m, '$.gameId') AS "gameId",
              CAST(json_extract_string(m, '$.win') AS INT) AS win,
              json_extract_string(m, '$.gameLabel') AS "gameLabel"
       FROM (SELECT json_object('gameId', CAST(o_orderkey AS VARCHAR), 'win', year(o_orderdate) % 2,
                                'gameLabel', o_orderpriority) AS m FROM orders) j"""
)
def json_round_trip(t: Tables) -> DataFrame:
    """Messages read back with the typed schema."""
    from pyspark.sql import types as T

    schema = T.StructType().add("gameId", "string").add("win", "integer").add("gameLabel", "string")
    return parse_json(json_encode(t), schema)


_SHOT_NAMES = {
    "l_orderkey": "partido_id", "l_suppkey": "jugador_id", "l_linenumber": "numero_tiro",
    "l_partkey": "defensor", "l_quantity": "distancia_tiro", "l_extendedprice": "puntos",
    "l_discount": "tiempo_posesion", "l_tax": "tiempo_con_balon", "l_returnflag": "resultado",
    "l_linestatus": "local_visitante", "l_shipdate": "fecha_partido",
}


@query("SELECT " + ", ".join(f"{a} AS {b}" for a, b in _SHOT_NAMES.items()) + " FROM lineitem")
def shots_rename(t: Tables) -> DataFrame:
    return t.read("lineitem").select(*[F.col(a).alias(b) for a, b in _SHOT_NAMES.items()])


@query(
    """SELECT p_partkey, p_name, CASE WHEN contains(p_type, 'STANDARD') THEN 1 ELSE 0 END AS is_three,
              CASE WHEN contains(p_type, 'STANDARD') THEN 3 ELSE 2 END AS shot_value,
              CASE WHEN p_brand = 'Brand#1' THEN 1 ELSE 0 END AS made FROM part"""
)
def shot_features(t: Tables) -> DataFrame:
    three = contains_flag("p_type", "STANDARD")
    return t.read("part").select(
        "p_partkey",
        "p_name",
        three.alias("is_three"),
        F.when(three == 1, 3).otherwise(2).alias("shot_value"),
        equals_flag("p_brand", "Brand#1").alias("made"),
    )


@query("SELECT personid, season, salary_usd FROM salaries", ["salaries"])
def salary_unpivot(t: Tables) -> DataFrame:
    wide = salary_wide(t)
    years = [c for c in wide.columns if c != "personid"]
    seasons = {c: f"{c[1:]}-{(int(c[1:]) + 1) % 100:02d}" for c in years}
    return unpivot_positive(wide, ["personid"], seasons, "season", "salary_usd")


@query(
    r"""SELECT p_partkey, trim(split_part(p_name, ' ', 1)) AS firstname,
               trim(regexp_replace(p_name, '^\S+\s+', '')) AS lastname,
               lower(trim(p_name)) AS name_key FROM part"""
)
def name_split(t: Tables) -> DataFrame:
    return t.read("part").select(
        "p_partkey",
        first_token("p_name").alias("firstname"),
        after_first_token("p_name").alias("lastname"),
        name_key("p_name").alias("name_key"),
    )


def _misspelled(t: Tables) -> DataFrame:
    """Part names without vowels in the first word."""
    first = F.regexp_replace(first_token("p_name"), "[aeiou]", "")
    return t.read("part").select(
        "p_partkey", F.concat(first, F.lit(" "), after_first_token("p_name")).alias("fullname")
    )


def _edit_matches(t: Tables) -> DataFrame:
    return best_match(
        _misspelled(t), t.read("part"), "fullname", "p_name", "p_partkey", EditSimilarity()
    )


_EDIT_SQL = rf"""
    WITH salaries AS (SELECT p_partkey, concat(regexp_replace(trim(split_part(p_name, ' ', 1)),
                             '[aeiou]', '', 'g'), ' ', trim(regexp_replace(p_name, '^\S+\s+', ''))) AS fullname
                      FROM part),
         registry AS (SELECT lower(trim(p_name)) AS reg_name, MIN(p_partkey) AS reg_id FROM part GROUP BY 1),
         names AS (SELECT DISTINCT lower(trim(fullname)) AS name FROM salaries),
         scored AS (SELECT name, reg_id, reg_name,
                           1.0::DOUBLE - levenshtein(name, reg_name)::DOUBLE
                             / greatest(length(name), length(reg_name))::DOUBLE AS score
                    FROM names CROSS JOIN registry),
         best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name
                                 ORDER BY score DESC, reg_id) AS rn FROM scored) s
                  WHERE rn = 1 AND score >= {THRESHOLD} - 1e-9)
    SELECT s.p_partkey, s.fullname, b.reg_id AS match_id, b.reg_name AS match_name, b.score AS match_score
    FROM salaries s LEFT JOIN best b ON lower(trim(s.fullname)) = b.name"""


@query(_EDIT_SQL)
def edit_match(t: Tables) -> DataFrame:
    return _edit_matches(t)


# Matching blocks: the longest common run (the first of equal ones in the name, then in the registry
# name), then the same left and right of it. 2M <= 2 common letters, and each of the other letters
# costs an edit at most, so names with more edits than (1 - threshold) of all letters can't match.
_LONGEST_RUN = """list_max(list_prepend(0::BIGINT, flatten(list_transform(range({al}, {ah}), lambda i: list_transform(range({bl}, {bh}),
    lambda j: len(list_filter(range(1, least({ah} - i, {bh} - j) + 1), lambda t: a[i:i + t - 1] = b[j:j + t - 1])) * 1000000
              + (999 - i) * 1000 + 999 - j)))))"""
_FUZZY_SQL = rf"""
    WITH RECURSIVE salaries AS (SELECT p_partkey, concat(regexp_replace(trim(split_part(p_name, ' ', 1)),
                             '[aeiou]', '', 'g'), ' ', trim(regexp_replace(p_name, '^\S+\s+', ''))) AS fullname
                      FROM part),
         registry AS (SELECT lower(trim(p_name)) AS reg_name, MIN(p_partkey) AS reg_id FROM part GROUP BY 1),
         names AS (SELECT DISTINCT lower(trim(fullname)) AS name FROM salaries),
         pairs AS (SELECT name AS a, reg_name AS b, reg_id FROM names CROSS JOIN registry
                   WHERE levenshtein(name, reg_name) <= {1 - THRESHOLD} * (length(name) + length(reg_name)) + 1e-9),
         blocks AS (
             SELECT a, b, 1::BIGINT AS al, length(a) + 1 AS ah, 1::BIGINT AS bl, length(b) + 1 AS bh,
                    {_LONGEST_RUN.format(al="1", ah="length(a) + 1", bl="1", bh="length(b) + 1")} AS run
             FROM pairs
             UNION ALL
             SELECT a, b, al, ah, bl, bh, {_LONGEST_RUN.format(al="al", ah="ah", bl="bl", bh="bh")} AS run
             FROM (SELECT a, b,
                          CASE WHEN side = 0 THEN al ELSE i + k END AS al, CASE WHEN side = 0 THEN i ELSE ah END AS ah,
                          CASE WHEN side = 0 THEN bl ELSE j + k END AS bl, CASE WHEN side = 0 THEN j ELSE bh END AS bh
                   FROM (SELECT *, run // 1000000 AS k, 999 - run // 1000 % 1000 AS i, 999 - run % 1000 AS j
                         FROM blocks WHERE run >= 1000000) w CROSS JOIN (VALUES (0), (1)) sides(side)) parts
             WHERE al < ah AND bl < bh),
         scored AS (SELECT a AS name, b AS reg_name, reg_id,
                           2.0::DOUBLE * sum(run // 1000000) / (length(a) + length(b)) AS score
                    FROM blocks JOIN pairs USING (a, b) GROUP BY a, b, reg_id),
         best AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY name
                                 ORDER BY score DESC, reg_id, reg_name) AS rn FROM scored) s
                  WHERE rn = 1 AND score >= {THRESHOLD} - 1e-9)
    SELECT s.p_partkey, s.fullname, b.reg_id AS match_id, b.reg_name AS match_name, b.score AS match_score
    FROM salaries s LEFT JOIN best b ON lower(trim(s.fullname)) = b.name"""


@query(_FUZZY_SQL)
def fuzzy_match(t: Tables) -> DataFrame:
    """Best match by matching blocks."""
    return best_match(_misspelled(t), t.read("part"), "fullname", "p_name", "p_partkey", BlockRatio())


@query(
    f"""SELECT count(*) AS total, count(match_id) AS matched, count(*) - count(match_id) AS unmatched,
               CAST(ROUND(CAST(count(match_id) / NULLIF(CAST(count(*) AS DOUBLE), 0) * 100
                    AS DECIMAL(18,9)), 1) AS DOUBLE) AS coverage_pct,
               count(*) FILTER (WHERE match_score < 0.95) AS low_confidence
        FROM ({_EDIT_SQL}) m"""
)
def coverage(t: Tables) -> DataFrame:
    return match_coverage(_edit_matches(t), F.col("match_id").isNotNull(), F.col("match_score"))


_GAMES_SQL = """SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY personid, gameid
    ORDER BY gamedatetimeest DESC, linenumber DESC, points DESC, price DESC, reboundsdefensive DESC,
             reboundsoffensive DESC) AS rn FROM box) b WHERE rn = 1"""


@query(
    f"""WITH games AS ({_GAMES_SQL}),
             played AS (SELECT personid, firstname || ' ' || lastname AS player_name, gameid, playerteamname,
                               points, assists, reboundsoffensive, reboundsdefensive,
                               CAST(numminutes AS DOUBLE) AS numminutes,
                               CAST(gamedatetimeest AS DATE) AS game_date
                        FROM games WHERE numminutes > 0),
             lagged AS (SELECT *, LAG(game_date) OVER (PARTITION BY personid ORDER BY game_date, gameid)
                               AS prev_game_date FROM played)
        SELECT *, COALESCE(date_diff('day', prev_game_date, game_date) = 1, false) AS is_back_to_back
        FROM lagged""",
    ["box"],
)
def game_logs(t: Tables) -> DataFrame:
    games_per_person = t.read("lineitem").select(
        F.col("l_suppkey").alias("personid"),
        F.col("l_shipdate").cast("date").alias("game_date"),
        F.col("l_orderkey").alias("gameid"),
    )
    counters = ("points", "assists", "reboundsoffensive", "reboundsdefensive")
    return marts.game_logs(games(t), counters, sizes_from=games_per_person)


@query(
    f"""WITH games AS ({_GAMES_SQL}),
             base AS (SELECT personid, firstname || ' ' || lastname AS player_name, playerteamname,
                             CAST(CASE WHEN month(gamedatetimeest) >= 10 THEN year(gamedatetimeest)
                                  ELSE year(gamedatetimeest) - 1 END AS BIGINT) AS season_start_year,
                             gameid, points, assists, reboundsoffensive + reboundsdefensive AS rebounds,
                             linenumber % 3 AS steals, linenumber % 2 AS blocks, linenumber % 5 AS turnovers
                      FROM games WHERE numminutes > 0)
        SELECT b.personid, b.player_name, b.playerteamname, b.season_start_year,
               COUNT(b.gameid) AS total_games_played, CAST(SUM(b.points) AS BIGINT) AS total_points,
               CAST(ROUND(CAST(AVG(b.points) AS DECIMAL(18,9)), 1) AS DOUBLE) AS avg_points,
               CAST(SUM(b.assists) AS BIGINT) AS total_assists,
               CAST(ROUND(CAST(AVG(b.assists) AS DECIMAL(18,9)), 1) AS DOUBLE) AS avg_assists,
               CAST(SUM(b.rebounds) AS BIGINT) AS total_rebounds_sum,
               CAST(ROUND(CAST(AVG(b.rebounds) AS DECIMAL(18,9)), 1) AS DOUBLE) AS avg_rebounds,
               CAST(SUM(b.steals) AS BIGINT) AS total_steals,
               CAST(SUM(b.blocks) AS BIGINT) AS total_blocks,
               CAST(SUM(b.turnovers) AS BIGINT) AS total_turnovers,
               COALESCE(MAX(s.salary_usd), 0) AS salary_usd
        FROM base b LEFT JOIN (SELECT personid, MAX(salary_usd) AS salary_usd FROM salaries
                               GROUP BY personid) s ON b.personid = s.personid
        GROUP BY 1, 2, 3, 4""",
    ["box", "salaries"],
)
def season_stats(t: Tables) -> DataFrame:
    """On one line per person and game; three more counters are made from the line number."""
    line = F.col("linenumber")
    more = {"steals": line % 3, "blocks": line % 2, "turnovers": line % 5}
    return marts.season_stats(game_lines(t).withColumns(more), salary_unpivot(t), persons=persons(t))


def _refreshed_twice(t: Tables, rows: DataFrame, name: str, keys: list[str], **layout) -> DataFrame:
    """``rows`` published twice as a mart; each version is shown only if its keys are unique."""
    path = new_folder(t.spark, name)
    for _ in range(2):
        publish(rows, path, check=lambda df: assert_unique(require_non_empty(df, name), keys), **layout)
    return read_published(t.spark, path, rows.schema).select(rows.columns)


@query(ORACLES["season_stats"])
def warehouse_refresh(t: Tables) -> DataFrame:
    """The season mart written twice by full refresh, partitioned and sorted, and read back."""
    return _refreshed_twice(
        t,
        season_stats(t),
        "season-mart",
        ["personid", "player_name", "playerteamname", "season_start_year"],
        partition_by=["season_start_year"],
        sort_by=["playerteamname", "personid"],
    )


@query(ORACLES["game_logs"])
def game_log_refresh(t: Tables) -> DataFrame:
    """The game log mart written twice by full refresh, by team, and read back."""
    return _refreshed_twice(
        t,
        game_logs(t),
        "game-log-mart",
        ["personid", "gameid"],
        partition_by=["playerteamname"],
        sort_by=[F.col("game_date").desc(), "personid"],
    )
