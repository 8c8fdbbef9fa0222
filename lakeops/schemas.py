"""Table schemas. Column names and types are fixed values of the tables' formats."""

from __future__ import annotations

from pyspark.sql import types as T

BOX_SCORE_LANDING = (
    T.StructType()
    .add("firstName", "string").add("lastName", "string")
    .add("personId", "string").add("gameId", "string")
    .add("playerteamName", "string").add("opponentteamName", "string")
    .add("gameType", "string").add("gameLabel", "string")
    .add("win", "integer").add("home", "integer").add("numMinutes", "integer")
    .add("points", "integer").add("assists", "integer").add("blocks", "integer").add("steals", "integer")
    .add("fieldGoalsAttempted", "integer").add("fieldGoalsMade", "integer")
    .add("threePointersAttempted", "integer").add("threePointersMade", "integer")
    .add("freeThrowsAttempted", "integer").add("freeThrowsMade", "integer")
    .add("reboundsDefensive", "integer").add("reboundsOffensive", "integer")
    .add("foulsPersonal", "integer").add("turnovers", "integer").add("plusMinus", "integer")
    .add("gameDateTimeEst", "timestamp")
)

# The file of box scores calls one column differently.
BOX_SCORE_FILE_NAMES = {"plusMinus": "plusMinusPoints"}

_PROCESSED_TYPES = {
    "personId": T.LongType(), "gameId": T.LongType(),
    "win": T.BooleanType(), "home": T.BooleanType(),
}
BOX_SCORE_PROCESSED = T.StructType(
    [T.StructField(f.name, _PROCESSED_TYPES.get(f.name, f.dataType)) for f in BOX_SCORE_LANDING.fields]
)

SALARY_SEASONS = tuple(f"{y}-{(y + 1) % 100}" for y in range(2025, 2031))
SALARY_LANDING = T.StructType(
    [
        T.StructField("fullname", T.StringType()),
        T.StructField("playerteamName", T.StringType()),
        *[T.StructField(s, T.DoubleType()) for s in SALARY_SEASONS],
    ]
)
SALARY_PROCESSED = (
    T.StructType()
    .add("personid", "long").add("player_name", "string").add("playerteamName", "string")
    .add("salary_usd", "long").add("season", "string")
)

GAME_LOGS = (
    T.StructType()
    .add("personid", "long").add("player_name", "string").add("gameid", "long")
    .add("playerteamname", "string")
    .add("points", "integer").add("assists", "integer")
    .add("reboundsoffensive", "integer").add("reboundsdefensive", "integer")
    .add("steals", "integer").add("blocks", "integer").add("turnovers", "integer")
    .add("numminutes", "double").add("game_date", "date").add("prev_game_date", "date")
    .add("is_back_to_back", "boolean")
)

SEASON_STATS = (
    T.StructType()
    .add("personid", "long").add("player_name", "string").add("playerteamname", "string")
    .add("season_start_year", "long").add("total_games_played", "long")
    .add("total_points", "long").add("avg_points", "double")
    .add("total_assists", "long").add("avg_assists", "double")
    .add("total_rebounds_sum", "long").add("avg_rebounds", "double")
    .add("total_steals", "long").add("total_blocks", "long").add("total_turnovers", "long")
    .add("salary_usd", "long")
)

SHOT_MESSAGE = (
    T.StructType()
    .add("GAME_ID", "string").add("player_name", "string")
    .add("SHOT_NUMBER", "integer").add("PERIOD", "integer").add("SHOT_DIST", "double")
    .add("SHOT_RESULT", "string").add("PTS", "integer")
)

SHOT_CHART_MESSAGE = (
    T.StructType()
    .add("id_partido", "string").add("fecha_partido", "string")
    .add("cuarto", "integer").add("minutos_restantes", "integer").add("segundos_restantes", "integer")
    .add("equipo_local", "string").add("equipo_visitante", "string")
    .add("equipo_tira", "string").add("jugador", "string")
    .add("distancia_pies", "integer").add("valor_tiro", "integer").add("anotado", "integer")
    .add("loc_x", "integer").add("loc_y", "integer").add("marcador_previo", "string")
)

# Daily box scores of the first feed.
DAILY_BOX_MESSAGE = (
    T.StructType()
    .add("slug", "string").add("name", "string").add("team", "string")
    .add("location", "string").add("opponent", "string").add("outcome", "string")
    .add("seconds_played", "integer")
    .add("made_field_goals", "integer").add("attempted_field_goals", "integer")
    .add("made_three_point_field_goals", "integer").add("attempted_three_point_field_goals", "integer")
    .add("made_free_throws", "integer").add("attempted_free_throws", "integer")
    .add("offensive_rebounds", "integer").add("defensive_rebounds", "integer").add("total_rebounds", "integer")
    .add("assists", "integer").add("steals", "integer").add("blocks", "integer").add("turnovers", "integer")
    .add("personal_fouls", "integer").add("game_score", "float").add("points", "integer")
    .add("fecha_partido", "string")
)

# Daily box scores of the second feed: date first, no sums, a score in double precision.
DAILY_BOX_DATED_MESSAGE = (
    T.StructType()
    .add("fecha_partido", "string").add("name", "string").add("slug", "string").add("team", "string")
    .add("location", "string").add("opponent", "string").add("outcome", "string")
    .add("seconds_played", "integer")
    .add("made_field_goals", "integer").add("attempted_field_goals", "integer")
    .add("made_three_point_field_goals", "integer").add("attempted_three_point_field_goals", "integer")
    .add("made_free_throws", "integer").add("attempted_free_throws", "integer")
    .add("offensive_rebounds", "integer").add("defensive_rebounds", "integer")
    .add("assists", "integer").add("steals", "integer").add("blocks", "integer").add("turnovers", "integer")
    .add("personal_fouls", "integer").add("game_score", "double")
)

# Shot log file columns and the names they get in the table.
SHOT_LOG_NAMES = {
    "GAME_ID": "partido_id", "MATCHUP": "emparejamiento", "LOCATION": "local_visitante",
    "W": "victoria", "FINAL_MARGIN": "margen_final", "SHOT_NUMBER": "numero_tiro",
    "PERIOD": "cuarto", "GAME_CLOCK": "tiempo_reloj", "SHOT_CLOCK": "tiempo_posesion",
    "DRIBBLES": "botes", "TOUCH_TIME": "tiempo_con_balon", "SHOT_DIST": "distancia_tiro",
    "PTS_TYPE": "valor_tiro", "SHOT_RESULT": "resultado", "CLOSEST_DEFENDER": "defensor",
    "CLOSE_DEF_DIST": "distancia_defensor", "FGM": "tiros_metidos", "PTS": "puntos",
    "player_name": "jugador", "player_id": "jugador_id",
}

ALL_TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Driver tables. A given schema saves the pass over the files that infers it.
DRIVER_TABLES = {
    "nation": T.StructType().add("n_nationkey", "integer").add("n_name", "string").add("n_regionkey", "integer"),
    "customer": (
        T.StructType()
        .add("c_custkey", "long").add("c_name", "string").add("c_nationkey", "integer")
        .add("c_acctbal", "double").add("c_mktsegment", "string")
    ),
    "supplier": (
        T.StructType()
        .add("s_suppkey", "long").add("s_name", "string").add("s_nationkey", "integer")
        .add("s_acctbal", "double")
    ),
    "part": (
        T.StructType()
        .add("p_partkey", "long").add("p_name", "string").add("p_brand", "string")
        .add("p_type", "string").add("p_size", "integer").add("p_retailprice", "double")
    ),
    "orders": (
        T.StructType()
        .add("o_orderkey", "long").add("o_custkey", "long").add("o_orderstatus", "string")
        .add("o_totalprice", "double").add("o_orderdate", "timestamp_ntz")
        .add("o_orderpriority", "string")
    ),
    "lineitem": (
        T.StructType()
        .add("l_orderkey", "long").add("l_partkey", "long").add("l_suppkey", "long")
        .add("l_linenumber", "integer").add("l_quantity", "double").add("l_extendedprice", "double")
        .add("l_discount", "double").add("l_tax", "double").add("l_returnflag", "string")
        .add("l_linestatus", "string").add("l_shipdate", "timestamp_ntz")
    ),
    "events": (
        T.StructType()
        .add("event_id", "long").add("ts", "timestamp_ntz").add("user_id", "long")
        .add("event_type", "string").add("value", "double").add("props", "string")
    ),
}
