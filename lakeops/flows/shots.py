"""Shots: the shot log table, and shots with the score at their time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeops import schemas
from lakeops.functions.text import contains_flag, equals_flag, is_digits, to_messages
from lakeops.operators.dedupe import latest_per_key
from lakeops.operators.joins import lookup
from lakeops.operators.windows import carry_forward
from lakeops.sources.files import read_csv, write_table
from lakeops.sources.layers import Lake
from lakeops.streaming.ingest import EVERY_10_SECONDS, ingest_json_stream

# Fixed value: score before the first one is known.
NO_SCORE = "0 - 0"

# Feed columns of a shot and the message fields they fill.
SHOT_FIELDS = {
    "GAME_ID": "id_partido", "GAME_DATE": "fecha_partido", "PERIOD": "cuarto",
    "MINUTES_REMAINING": "minutos_restantes", "SECONDS_REMAINING": "segundos_restantes",
    "HTM": "equipo_local", "VTM": "equipo_visitante", "TEAM_NAME": "equipo_tira",
    "PLAYER_NAME": "jugador", "SHOT_DISTANCE": "distancia_pies", "LOC_X": "loc_x", "LOC_Y": "loc_y",
}


def load_shot_log(spark: SparkSession, lake: Lake, csv_path: str) -> None:
    """Replace the shot table, by player, from a shot log file."""
    log = read_csv(spark, csv_path)
    rows = log.select(*[F.col(a).alias(b) for a, b in schemas.SHOT_LOG_NAMES.items()])
    write_table(rows, lake.path("landing", "shots"), mode="overwrite", partition_by=["jugador_id"])


def running_scores(actions: DataFrame, **limits) -> DataFrame:
    """(GAME_ID, actionNumber, score): last known score at each action of a game.

    ``position`` is the order of the actions within a game. An action number that occurs
    again has the score of its last occurrence.
    """
    score = F.concat(F.col("scoreHome"), F.lit(" - "), F.col("scoreAway"))
    known = is_digits("scoreHome") & F.col("scoreAway").isNotNull()
    scored = carry_forward(
        actions, ["GAME_ID"], ["position"], score, known, "score", NO_SCORE, **limits
    )
    last = latest_per_key(scored, ["GAME_ID", "actionNumber"], ["position"])
    return last.select("GAME_ID", "actionNumber", "score")


def shot_chart(shots: DataFrame, actions: DataFrame, **limits) -> DataFrame:
    """Shot messages: value (3 or 2), made (1 or 0) and the score at the shot."""
    return with_scores(shots, running_scores(actions, **limits))


def with_scores(shots: DataFrame, scores: DataFrame) -> DataFrame:
    """Fields of the shot messages; ``shots`` may be a stream, ``scores`` is a table.

    ``scores`` (see ``running_scores``) has one row per action, so a shot stays one row.
    """
    known = scores.withColumnRenamed("actionNumber", "GAME_EVENT_ID")
    rows = lookup(shots, known, ["GAME_ID", "GAME_EVENT_ID"], "score", NO_SCORE)
    three = contains_flag("SHOT_TYPE", "3PT")
    return rows.select(
        *[F.col(a).alias(b) for a, b in SHOT_FIELDS.items()],
        F.when(three == 1, 3).otherwise(2).alias("valor_tiro"),
        equals_flag("EVENT_TYPE", "Made Shot").alias("anotado"),
        F.col("score").alias("marcador_previo"),
    ).select(*[F.col(f.name).cast(f.dataType) for f in schemas.SHOT_CHART_MESSAGE.fields])


def land_shot_chart(
    shots: DataFrame, scores: DataFrame, path: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Start a query that looks up the score of each streamed shot and lands the message.

    The shot becomes JSON text, as it would be sent, and is parsed into the landing table.
    """
    messages = to_messages(with_scores(shots, scores), key="id_partido")
    return ingest_json_stream(
        messages, schemas.SHOT_CHART_MESSAGE, path, checkpoint, trigger=trigger or EVERY_10_SECONDS
    )
