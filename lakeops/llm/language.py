"""Languages of a text as a mixture, by expectation maximisation over n-gram likelihoods."""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import bounded_sample, map_slices, texts
from lakeops.workspace import stored

#: Documents of a language that are learned from, and n-grams that its model keeps.
SAMPLE, NGRAMS = 1000, 20_000
#: Letters of an n-gram; a word has one space before and after it.
N = 3
#: Steps of the mixture, and what a further language must add to the log likelihood.
STEPS, PENALTY = 12, 3.0

#: Characters of a text that are split into words at once, and words whose likelihoods a worker keeps.
PIECE, KNOWN_WORDS = 1 << 20, 300_000

WORDS = re.compile(r"[^\W\d_]+")


def word_counts(text: str) -> Counter:
    """The distinct words of a whole text in lower case, with their numbers."""
    counts: Counter = Counter()
    at = 0
    while at < len(text):
        end = text.find(" ", at + PIECE) if at + PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        counts.update(WORDS.findall(text[at:end].lower()))
        at = end
    return counts


def ngrams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + N] for i in range(max(1, len(padded) - N + 1))]


@dataclass
class Languages:
    """Names, and for each n-gram its log likelihood in each language; ``rest`` if unknown."""

    names: list[str]
    grams: dict[str, int]
    table: np.ndarray  # one row per n-gram, the last for unknown ones
    _places: dict = field(default_factory=dict, repr=False, compare=False)
    _shares: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_places": {}, "_shares": []}

    def _likelihoods(self, words: list[str]) -> np.ndarray:
        """A row for each word: its likelihood in each language, over the greatest of them."""
        parts = [[self.grams.get(g, -1) for g in ngrams(w)] for w in words]
        starts = np.cumsum([0] + [len(p) for p in parts[:-1]])
        flat = self.table[np.concatenate([np.array(p) for p in parts])]
        sums = np.add.reduceat(flat, starts, axis=0)
        return np.exp(np.maximum(sums - sums.max(axis=1, keepdims=True), -60.0))

    def _learn_words(self, batch: list[Counter]) -> None:
        """Work out the likelihoods of unseen words; words without a letter get no place."""
        places = self._places
        new = [w for w in dict.fromkeys(w for counts in batch for w in counts) if w not in places]
        spelled = [w for w in new if any(c.isalpha() for c in w)]
        places.update(dict.fromkeys(new, -1))
        if spelled:
            held = self._shares[0] if self._shares else np.zeros((0, len(self.table[0])))
            places.update((w, len(held) + i) for i, w in enumerate(spelled))
            self._shares[:] = [np.concatenate([held, self._likelihoods(spelled)])]

    def mixtures(self, batch: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Language shares of each text, and whether it has a word at all.

        A text counts as its distinct words with their numbers, so that memory is bounded by
        the vocabulary of the batch, however long its texts are.
        """
        if len(self._places) > KNOWN_WORDS:
            self._places.clear(), self._shares.clear()
        counted = [word_counts(t) for t in batch]
        self._learn_words(counted)
        places = self._places
        held = [[(at, n) for w, n in counts.items() if (at := places[w]) >= 0] for counts in counted]
        sizes = np.array([len(h) for h in held])
        some = sizes > 0
        shares = np.zeros((len(batch), len(self.names)))
        if some.any():
            rows = np.array([r for h in held for r in h])
            shares[some] = mixture(self._shares[0][rows[:, 0]], sizes[some], rows[:, 1].astype(float))
        return shares, some


def mixture(p: np.ndarray, sizes: np.ndarray, times: np.ndarray | None = None, steps: int = STEPS) -> np.ndarray:
    """Shares of the columns in each run of rows, from likelihoods by row.

    ``times`` says how often each row counts (once, if not given). Expectation maximisation
    from equal shares; then languages leave one by one, the smallest first, as long as that
    costs less likelihood than the penalty saves.
    """
    n, m = len(sizes), p.shape[1]
    times = np.ones(len(p)) if times is None else times
    starts = np.cumsum(np.r_[0, sizes[:-1]])
    totals = np.add.reduceat(times, starts)
    penalty = PENALTY + 0.5 * np.log(totals)

    def fit(share: np.ndarray, which: np.ndarray, rows: np.ndarray, count: np.ndarray, steps: int):
        at = np.cumsum(np.r_[0, sizes[which][:-1]])
        own = np.repeat(np.arange(len(which)), sizes[which])
        for _ in range(steps):
            joint = rows * share[own]
            joint *= (count / joint.sum(axis=1))[:, None]
            share = np.add.reduceat(joint, at, axis=0) / totals[which][:, None]
        likelihood = np.log((rows * share[own]).sum(axis=1)) * count
        return share, np.add.reduceat(likelihood, at)

    share, value = fit(np.full((n, m), 1.0 / m), np.arange(n), p, times, steps)
    used, live = (share > 0).sum(axis=1), np.arange(n)
    value = value - penalty * used
    row_of = np.repeat(np.arange(n), sizes)
    while len(live):
        live = live[used[live] > 1]
        if not len(live):
            break
        least = np.where(share[live] > 0, share[live], np.inf).argmin(axis=1)
        fewer = share[live].copy()
        fewer[np.arange(len(live)), least] = 0
        fewer = np.where(fewer > 0, fewer + 1e-6, 0)
        fewer /= fewer.sum(axis=1, keepdims=True)
        mask = np.zeros(n, bool)
        mask[live] = True
        tried, worth = fit(fewer, live, p[mask[row_of]], times[mask[row_of]], max(1, steps // 3))
        worth = worth - penalty[live] * (used[live] - 1)
        better = worth >= value[live]
        moved = live[better]
        share[moved], value[moved] = tried[better], worth[better]
        used[moved] = (share[moved] > 0).sum(axis=1)
        live = moved
    return share


def learn(docs: DataFrame, keep: Column, sample: int = SAMPLE) -> Languages:
    """Learn from at most ``sample`` documents of each non-NULL language where ``keep`` holds.

    A language keeps its NGRAMS most frequent n-grams. The driver holds one table of the
    n-grams that any language keeps.
    """
    rows = docs.select(F.col("doc_id").alias("id"), "lang", F.coalesce("text", F.lit("")).alias("text"))
    known = rows.select("id", "lang").filter("lang is not null").filter(keep)
    chosen = bounded_sample(known, "id", ["lang"], sample).select("id").distinct()
    learned = rows.filter("lang is not null").join(F.broadcast(chosen), "id")

    def count(batches):
        counts: dict[str, Counter] = {}
        for batch in batches:
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                words = word_counts(text)
                mine = counts.setdefault(lang, Counter())
                for word, times in words.items():
                    for g in ngrams(word):
                        mine[g] += times
        for lang, mine in counts.items():
            yield pa.record_batch(
                [pa.array([lang] * len(mine), pa.string()), pa.array(list(mine), pa.string()), pa.array(list(mine.values()), pa.int64())],
                ["lang", "gram", "times"],
            )

    found = learned.select("lang", "text").mapInArrow(count, "lang string, gram string, times bigint")
    order = Window.partitionBy("lang").orderBy(F.desc("times"), "gram")
    totals = stored(found.groupBy("lang", "gram").agg(F.sum("times").alias("times")), "grams")
    top = totals.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= NGRAMS)
    names = sorted(r.lang for r in known.select("lang").distinct().collect())
    kept = top.select("lang", "gram", "times").collect()
    grams = {g: i for i, g in enumerate(sorted({r.gram for r in kept}))}
    table = np.full((len(grams) + 1, max(1, len(names))), 0.5)
    column = {name: i for i, name in enumerate(names)}
    for r in kept:
        table[grams[r.gram], column[r.lang]] += r.times
    return Languages(names, grams, np.log(table / table.sum(axis=0)))


def identify(docs: DataFrame, model: Languages, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, lang_pred, score and languages (name to share) of every row.

    The predicted language has the largest share of the text's words, which is the score;
    ties go to the first name. NULL text, text without a letter, and a model without
    languages give ``und`` with score 0 and no shares. Repeated rows and NULL ids are kept.
    Texts of any length are read whole; their distinct words are held.
    """

    def make():
        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            batch_texts = texts(batch, "text")
            shares, some = model.mixtures(batch_texts)
            if not model.names:
                some = np.zeros(len(batch_texts), bool)
            best = shares.argmax(axis=1)
            return pa.record_batch(
                [
                    batch.column("id"),
                    pa.array([model.names[b] if s else "und" for b, s in zip(best, some)], pa.string()),
                    pa.array([float(min(1.0, x.max())) if s else 0.0 for x, s in zip(shares, some)]),
                    pa.array(
                        [[(model.names[i], float(x[i])) for i in np.nonzero(x)[0]] if s else [] for x, s in zip(shares, some)],
                        pa.map_(pa.string(), pa.float64()),
                    ),
                ],
                ["id", "lang_pred", "score", "languages"],
            )

        return work

    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return map_slices(
        chosen, "text", make, f"id {kind}, lang_pred string, score double, languages map<string,double>"
    )
