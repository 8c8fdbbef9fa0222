"""Importance resampling: draw the documents that look most like a target text collection."""

from __future__ import annotations

import math
from dataclasses import dataclass
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import blocks, map_slices, numbered, slices
from lakeops.workspace import stored

#: Letters A-Z become small, and every other ASCII sign but letters and digits a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b > 127 else 32 for b in range(256)
)
#: Bytes of a text whose words are held at once.
BLOCK = 1 << 20
#: Thresholds that one job counts; each job divides the interval by one more than that.
THRESHOLDS = 15


def _after_space() -> np.ndarray:
    """For a last byte of a running crc32, what one more space makes of it."""
    table = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        table = np.where(table & 1, (table >> 1) ^ np.uint32(0xEDB88320), table >> 1)
    return table


_CRC = _after_space()


def with_space(crc: np.ndarray) -> np.ndarray:
    """crc32 of each text followed by a space, from the crc32 of the text."""
    x = ~crc
    return ~(_CRC[(x ^ np.uint32(32)) & np.uint32(255)] ^ (x >> np.uint32(8)))


def features(text: bytes, buckets: int):
    """Arrays of the buckets of all words and of all pairs of words; with them, words counted."""
    last = None
    for block in blocks(text.translate(_FOLD), BLOCK, b" "):
        words = block.split()
        if not words:
            continue
        one = np.fromiter(map(crc32, words), np.uint32, len(words))
        yield one % np.uint32(buckets), len(words)
        first = one if last is None else np.concatenate([last, one])
        if last is None:
            words = words[1:]
        last = one[-1:]
        if words:
            two = map(crc32, words, with_space(first[:-1]).tolist())
            yield np.fromiter(two, np.uint32, len(words)) % np.uint32(buckets), 0


def bucket_counts(docs: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Features of all texts in each bucket: arrays added up in each task, then by Spark."""

    def run(batches):
        counts = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                for text in piece.column("text"):
                    for found, _ in features(text.as_py() or b"", buckets):
                        counts += np.bincount(found, minlength=buckets)
        held = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(held, pa.int64()), pa.array(counts[held])], ["bucket", "n"])

    chosen = docs.select(docs[text_col].cast("binary").alias("text"))
    found = chosen.mapInArrow(run, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for r in found.collect():  # at most one row for each bucket
        out[r.bucket] = r.n
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of how much likelier each bucket is in the target, both with one added."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    ratio = [
        float(t + 1) * float(s_all + b) / (float(s + 1) * float(t_all + b))
        for s, t in zip(corpus.tolist(), target.tolist())
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def weights(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features, weight: the floored mean gain of each text's features."""
    buckets = len(gain)

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            rows = []
            for text in batch.column("text"):
                words = n = total = 0
                for found, count in features(text.as_py() or b"", buckets):
                    words, n, total = words + count, n + len(found), total + int(gain[found].sum())
                rows.append((words, n, total // n if n else 0))
            columns = zip(*rows) if rows else ([], [], [])
            return pa.record_batch(
                [batch.column("doc_id"), *(pa.array(c, pa.int64()) for c in columns)],
                ["doc_id", "n_words", "n_features", "weight"],
            )

        return work

    chosen = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].cast("binary").alias("text"))
    return map_slices(chosen, "text", make, "doc_id bigint, n_words bigint, n_features bigint, weight bigint")


def noise(id_col: str, seed: int) -> Column:
    """floor(-1000 ln(-ln u)) with u from the first 32 bits of sha256 of seed and id."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


@dataclass
class Cutoff:
    """Rows above ``score`` are drawn, and those at it up to ``doc_id``."""

    score: int
    doc_id: int

    def drawn(self) -> Column:
        at = (F.col("score") == self.score) & F.coalesce(F.col("doc_id") <= self.doc_id, F.lit(False))
        return (F.col("score") > self.score) | at


def least(df: DataFrame, passes, low: int, high: int, wanted: int) -> int:
    """The smallest value v of low..high for which ``wanted`` rows or more pass ``passes(v)``.

    Every job counts all rows exactly at THRESHOLDS values of the interval that is left. The
    count does not fall as v rises; at ``high`` it is taken to be enough.
    """
    while low < high:
        step = max(1, (high - low) // (THRESHOLDS + 1))
        tries = [low + i * step for i in range(THRESHOLDS) if low + i * step < high]
        got = df.agg(*(F.count_if(passes(v)).alias(f"n{i}") for i, v in enumerate(tries))).first()
        enough = [v for v, n in zip(tries, got) if n >= wanted]
        short = [v for v, n in zip(tries, got) if n < wanted]
        low, high = (short[-1] + 1 if short else low), (enough[0] if enough else high)
    return high


def cutoff(rows: DataFrame, draw: int) -> Cutoff | None:
    """Where the ``draw`` best rows of (score, doc_id) end: highest score, then smallest id.

    NULL ids come after all others of their score.
    """
    ends = rows.agg(F.min("score"), F.max("score"), F.min("doc_id"), F.max("doc_id")).first()
    if draw <= 0 or ends[0] is None:
        return None
    # -v rises as the score falls
    score = -least(rows, lambda v: F.col("score") >= -v, -ends[1], -ends[0], draw)
    above = rows.filter(F.col("score") > score).count()
    at = rows.filter(F.col("score") == score)
    if ends[2] is None:
        return Cutoff(score - 1, 0)
    held = at.filter("doc_id is not null").count()
    if held < draw - above:  # rows without an id are drawn too: take all of the score, and rank
        return Cutoff(score - 1, 0)
    return Cutoff(score, least(at, lambda v: F.col("doc_id") <= v, ends[2], ends[3], draw - above))


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 25,
    buckets: int = 10_000,
    least_words: int = 20,
    seed: int = 7,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_col: str = "text",
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every document; rank is NULL if undrawn.

    Texts are bags of hashed words and pairs of words. A document's weight is the mean log
    ratio of the target's bucket shares to the corpus's own; with Gumbel noise from a hash of
    its id, the highest scores are a draw without replacement. ``percent`` % of the documents
    of at least ``least_words`` words are drawn.

    The cutoff is found by counting over the written scores; only drawn rows are sorted, by
    ranges. NULL and empty texts have no features and weight 0; the noise of a NULL id is that
    of an empty one, and NULL ids rank last among equal scores. Repeated rows are drawn
    and ranked each. Without documents there are no rows; without target texts the target is
    even over all buckets. Long texts are read in blocks of BLOCK bytes.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_col, buckets))
    scored = weights(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise("doc_id", seed))
    scored = stored(scored, "scores")
    long_ = F.col("n_words") >= least_words
    able = scored.filter(long_)
    draw = percent * able.count() // 100
    cut = cutoff(able, draw)
    columns = ["doc_id", "n_features", "weight", "score"]
    none = F.lit(None).cast("long").alias("rank")
    if cut is None:
        return scored.select(*columns, none)
    order = [F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("weight"), F.asc("n_features")]
    ranked = numbered(able.filter(cut.drawn()).select(*columns), order)
    # more than ``draw`` rows only where an id repeats or is NULL
    place = F.when(F.col("number") < draw, F.col("number") + 1).alias("rank")
    rest = scored.filter(~(long_ & cut.drawn())).select(*columns, none)
    return ranked.select(*columns, place).unionByName(rest)
