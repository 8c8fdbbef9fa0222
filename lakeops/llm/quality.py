"""Quality by compression: dictionaries of good and bad text, and the difference they make."""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.learning import labelled, logistic, scored, sigmoid

#: Bytes that are compressed at once; every byte of a text is in one such piece.
PIECE = 1024
#: Bytes of each dictionary, and labelled documents of each kind that are learned from.
DICTIONARY, SAMPLE = 64 * 1024, 1500
#: Pieces of a sampled document that are learned from, spread evenly over it.
SAMPLE_PIECES = 16
LEVEL = 3


def pieces(text: str, size: int = PIECE) -> list[bytes]:
    data = text.encode()
    return [data[i : i + size] for i in range(0, len(data), size)]


@dataclass
class Quality:
    """Two dictionaries, the weights of the calibrated score, and the score of no text."""

    good: bytes
    bad: bytes
    weights: list[float]
    prior: float
    _made: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_made": []}

    def _compressors(self) -> list:
        if not self._made:
            self._made += compressors(self.good, self.bad)
        return self._made

    def score(self, text: str) -> float:
        """How likely the text is good; the empty text gets the share of good ones."""
        if not text or not self.weights:
            return self.prior
        x = features(text, self._compressors())
        return float(sigmoid(x @ np.array(self.weights[:-1]) + self.weights[-1]))


def compressors(*dictionaries: bytes) -> list:
    made = []
    for data in dictionaries:
        known = zstandard.ZstdCompressionDict(data)
        known.precompute_compress(level=LEVEL)
        made.append(
            zstandard.ZstdCompressor(
                level=LEVEL, dict_data=known, write_checksum=False, write_content_size=False,
                write_dict_id=False,
            )
        )
    return made


def features(text: str, made: list) -> np.ndarray:
    """The normalised difference of the compressed sizes, its largest and least piece, and how
    far the text can be compressed at all.
    """
    parts = pieces(text)
    good, bad = made
    sizes = np.array([(len(good.compress(p)), len(bad.compress(p)), len(p)) for p in parts], float)
    # a frame of a short piece is mostly its header: pieces count with a few bytes more
    each = (sizes[:, 0] - sizes[:, 1]) / (sizes[:, :2].max(axis=1) + 32)
    total = sizes.sum(axis=0)
    whole = (total[0] - total[1]) / (max(total[0], total[1]) + 32)
    tight = np.log((min(total[0], total[1]) + 16) / (total[2] + 16))
    return np.array([whole, each.max(), each.min(), tight, min(tight + 1.5, 0.0)])


def learn(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> Quality:
    """Learn from at most ``sample`` documents of each label for which ``keep`` (of id) holds.

    Half of them build the dictionaries, half calibrate the score. The driver holds the
    sample's pieces, at most 2 x sample x SAMPLE_PIECES x PIECE bytes. Without both labels
    the score is the share of good documents (0.5 without labels).
    """
    rows = labelled(docs, labels, "quality", keep, sample).withColumn(
        "build", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(2)) == 0
    )

    @F.pandas_udf("array<binary>")
    def spread(texts: pd.Series) -> pd.Series:
        def some(text):
            all_ = pieces(text)
            at = np.unique(np.linspace(0, max(len(all_) - 1, 0), SAMPLE_PIECES).astype(int))
            return [all_[i] for i in at if i < len(all_)]

        return texts.map(some)

    built = rows.filter("build").select("y", F.explode(spread("text")).alias("piece")).collect()
    by = {y: [bytes(r.piece) for r in built if int(r.y) == y] for y in (0, 1)}
    counts = {int(r.y): r["count"] for r in rows.groupBy("y").count().collect()}
    all_ = counts.get(0, 0) + counts.get(1, 0)
    prior = counts.get(1, 0) / all_ if all_ else 0.5
    if not by[0] or not by[1]:
        return Quality(b"", b"", [], prior)
    lines = [{x for piece in by[y] for x in piece.split(b"\n")} for y in (0, 1)]
    both = lines[0] & lines[1]  # lines that both kinds hold say nothing
    own = {y: [b"\n".join(x for x in p.split(b"\n") if x not in both) for p in by[y]] for y in by}
    good, bad = (dictionary([p for p in own[y] if p] or by[y]) for y in (1, 0))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        made = compressors(good, bad)
        return texts.map(lambda t: features(t, made).tolist())

    rest = rows.filter("not build and text <> ''").select("y", measured("text").alias("x")).collect()
    if len({int(r.y) for r in rest}) < 2:
        return Quality(b"", b"", [], prior)
    x, y = np.array([r.x for r in rest]), np.array([float(r.y) for r in rest])
    return Quality(good, bad, logistic(x, y).tolist(), prior)


def dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; too few samples are a dictionary as they are."""
    try:
        return zstandard.train_dictionary(DICTIONARY, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[-DICTIONARY:]


def quality_score(model: Quality, text: Column) -> Column:
    """The score of every whole text, from 0 to 1; NULL is the empty text."""
    return scored(model.score)(text)
