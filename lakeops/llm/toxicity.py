"""Toxicity by a weighted finite-state grammar over clauses."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.learning import labelled, logistic, scored, sigmoid, without_copies
from lakeops.workspace import stored

#: Labelled documents of each kind that are learned from.
SAMPLE = 3000
#: Weight of a threat before any document is seen, and how many documents that counts for.
SEED_WEIGHT, SEED_DOCS = 3.0, 3
#: Words whose symbol a worker process keeps; a full table is emptied.
KNOWN_WORDS = 100_000
#: Stems are the first letters of words, this many.
STEM_SIZES = (4, 5, 6, 8)
#: Toxic documents that must hold a stem, and how sure it must be.
LEAST_DOCS, LEAST_PRECISION = 3, 0.85

# Words that open or bend a clause, in the languages of the corpus.
NEGATION = "not no never none nicht kein keine nie pas ne jamais aucun nunca jamás ningún sin n't".split()
REPORTED = (
    "said says say told wrote claims claimed quoted called sagte sagt schrieb behauptet"
    " dit disait écrit affirme dijo dice escribió afirma"
).split()
TARGET = (
    "you your yours they them he she people du dich dir ihr euch sie tu toi vous ils elles"
    " tú te usted ustedes ellos ellas"
).split()
THREAT = (
    "kill hurt beat destroy stab shoot töten schlagen zerstören tuer frapper détruire"
    " matar golpear destruir"
).split()

WORDS = re.compile(r"n't|[^\W\d_]+|[.!?;:\n]")
#: Characters of a text that are split into words at once.
PIECE = 1 << 20
#: Input symbols of the transducers.
OTHER, END, NEGATES, REPORTS, POINTS, THREATENS, INSULTS = range(7)
SYMBOLS = 7


def words_of(text: str) -> Iterator[str]:
    """Words and clause ends of a whole text in lower case; "aren't" is "are" and "n't"."""
    at = 0
    while at < len(text):
        end = text.find("\n", at + PIECE) if at + PIECE < len(text) else -1
        end = len(text) if end < 0 else end
        yield from WORDS.findall(text[at:end].lower().replace("’", "'").replace("n't", " n't "))
        at = end


@dataclass
class Transducer:
    """States that read the symbols of a clause and weigh what is matched in it.

    ``step`` gives the next state, ``factor`` the weight of a match that is read in a state,
    ``final`` that of the whole clause if it ends there, and ``accepts`` the symbols whose
    matches count if it ends there. State 0 is the start of a clause.
    """

    step: list[list[int]]
    factor: list[float]
    final: list[float]
    accepts: list[frozenset]


def _machine(arcs: dict[tuple[int, int], int], states: int, factor=None, final=None, accepts=None) -> Transducer:
    """A state stays where no arc leads on."""
    step = [[arcs.get((s, x), s) for x in range(SYMBOLS)] for s in range(states)]
    return Transducer(
        step, factor or [1.0] * states, final or [1.0] * states, accepts or [frozenset()] * states
    )


def insult() -> Transducer:
    """A clause with an insult matches it."""
    return _machine({(0, INSULTS): 1}, 2, accepts=[frozenset(), frozenset([INSULTS])])


def threat() -> Transducer:
    """A clause matches its threat if it also holds a target, before or after."""
    arcs = {(0, THREATENS): 1, (0, POINTS): 2, (1, POINTS): 3, (2, THREATENS): 3}
    return _machine(arcs, 4, accepts=[frozenset()] * 3 + [frozenset([THREATENS])])


def in_clause(symbol: int, factor: float) -> Transducer:
    """A clause with ``symbol`` anywhere weighs ``factor`` times as much."""
    return _machine({(0, symbol): 1}, 2, final=[1.0, factor])


def window(symbol: int, reach: int, factor: float) -> Transducer:
    """After ``symbol``, the next ``reach`` words of the clause are matched with ``factor``."""
    arcs = {(s, x): max(s - 1, 0) for s in range(reach + 1) for x in range(SYMBOLS)}
    arcs |= {(s, symbol): reach for s in range(reach + 1)}
    return _machine(arcs, reach + 1, factor=[1.0] + [factor] * reach)


def composed(parts: list[Transducer]) -> Transducer:
    """One transducer that runs all of ``parts``: weights multiply, and what any accepts counts."""
    both = _machine({}, 1)
    for part in parts:
        pairs = [(a, b) for a in range(len(both.step)) for b in range(len(part.step))]
        n = len(part.step)
        both = Transducer(
            [[both.step[a][x] * n + part.step[b][x] for x in range(SYMBOLS)] for a, b in pairs],
            [both.factor[a] * part.factor[b] for a, b in pairs],
            [both.final[a] * part.final[b] for a, b in pairs],
            [both.accepts[a] | part.accepts[b] for a, b in pairs],
        )
    return both


def grammar() -> Transducer:
    """Insults, and threats at a target; a target in the clause strengthens it, reported
    speech weakens it, and negation weakens the next three words.
    """
    return composed(
        [insult(), threat(), in_clause(POINTS, 1.5), in_clause(REPORTS, 0.5), window(NEGATES, 3, 0.5)]
    )


@dataclass
class Toxicity:
    """Weighted stems of insults (a word ends in "$"), weights of the score, the prior, and
    weighted words of threats.
    """

    stems: dict[str, float]
    weights: list[float]
    prior: float
    threats: dict[str, float] = field(default_factory=lambda: dict.fromkeys(THREAT, SEED_WEIGHT))
    _known: dict = field(default_factory=dict, repr=False, compare=False)
    _machine: list = field(default_factory=list, repr=False, compare=False)

    def __getstate__(self):
        return {**self.__dict__, "_known": {}, "_machine": []}

    def symbol(self, word: str) -> tuple[int, float]:
        """The transducers' symbol of a word, and the weight of what it matches."""
        if not word[0].isalpha() and len(word) == 1:
            return END, 0.0
        found = [self.stems[k] for k in keys(word) if k in self.stems]
        if found:
            return INSULTS, max(found)
        for symbol, words in ((NEGATES, NEGATION), (REPORTS, REPORTED), (POINTS, TARGET)):
            if word in words:
                return symbol, 0.0
        return (THREATENS, self.threats[word]) if word in self.threats else (OTHER, 0.0)

    def matches(self, text: str) -> list[tuple[int, str, float]]:
        """(clause, word, weight) of each match, the clause counted from 0.

        Of the threats of a clause the heaviest is the match. A long text is read clause by
        clause.
        """
        if not self._machine:
            self._machine.append(grammar())
        machine, known = self._machine[0], self._known
        step, factor = machine.step, machine.factor
        found, clause, state = [], 0, 0
        held: list[tuple[int, str, float]] = []  # what the clause may match

        def close():
            accepted, final = machine.accepts[state], machine.final[state]
            threats = [h for h in held if h[0] == THREATENS]
            worst = max(threats, key=lambda h: h[2], default=None)
            found.extend(
                (clause, word, weight * final)
                for at, (symbol, word, weight) in enumerate(held)
                if symbol in accepted and (symbol != THREATENS or held[at] is worst)
            )
            held.clear()

        for word in words_of(text):
            s = known.get(word)
            if s is None:
                if len(known) > KNOWN_WORDS:
                    known.clear()
                s = known[word] = self.symbol(word)
            symbol, value = s
            if symbol == END:
                if held:
                    close()
                state, clause = 0, clause + 1
                continue
            if symbol >= THREATENS:
                held.append((symbol, word, value * factor[state]))
            state = step[state][symbol]
        if held:
            close()
        return found

    def features(self, text: str) -> list[float]:
        """The heaviest clause, and all clauses together, on a log scale.

        A clause weighs what its matched words weigh, each once; clauses that match the same
        words count once, as the heaviest of them.
        """
        clauses: dict[int, dict[str, float]] = {}
        for clause, word, weight in self.matches(text):
            words = clauses.setdefault(clause, {})
            words[word] = max(words.get(word, 0.0), weight)
        kinds: dict[frozenset, float] = {}
        for words in clauses.values():
            kind = frozenset(words)
            kinds[kind] = max(kinds.get(kind, 0.0), sum(words.values()))
        return [math.log1p(max(kinds.values(), default=0.0)), math.log1p(sum(kinds.values()))]

    def score(self, text: str) -> float:
        """How likely the text is toxic; without learned weights, the share of toxic ones."""
        if not self.weights:
            return self.prior
        return float(sigmoid(np.dot(self.features(text), self.weights[:-1]) + self.weights[-1]))


def keys(word: str) -> list[str]:
    return [word + "$", *(word[:n] for n in STEM_SIZES if len(word) >= n)]


def _stem_counts(rows: DataFrame) -> DataFrame:
    """stem, toxic documents, other documents; added up in each task before the shuffle."""

    def run(batches):
        counts = (Counter(), Counter())

        def flush():
            stems = list(counts[0].keys() | counts[1].keys())
            out = pa.record_batch(
                [pa.array(stems, pa.string())]
                + [pa.array([c[s] for s in stems], pa.int64()) for c in (counts[1], counts[0])],
                ["stem", "toxic", "other"],
            )
            counts[0].clear(), counts[1].clear()
            return out

        for batch in batches:
            for text, y in zip(batch.column("text").to_pylist(), batch.column("y").to_pylist()):
                words = {w for w in words_of(text) if w[0].isalpha()}
                counts[int(y)].update({k for w in words for k in keys(w)})
                if len(counts[0]) + len(counts[1]) > 500_000:
                    yield flush()
        yield flush()

    found = rows.select("text", F.col("y").cast("int").alias("y")).mapInArrow(
        run, "stem string, toxic bigint, other bigint"
    )
    return found.groupBy("stem").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))


def _threats(build: DataFrame, p: int, n: int) -> dict[str, float]:
    """Weights of threats from the documents in which each is matched, drawn to SEED_WEIGHT."""
    model = Toxicity({}, [], 0.0)

    @F.pandas_udf("array<string>")
    def matched(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: sorted({word for _, word, _ in model.matches(t)}))

    held = build.select("y", F.explode(matched("text")).alias("word"))
    counts = held.groupBy("word").agg(
        F.count(F.when(F.col("y") == 1, 1)).alias("toxic"), F.count(F.when(F.col("y") == 0, 1)).alias("other")
    )
    found = dict(model.threats)
    for r in counts.collect():  # one row for each word of THREAT at most
        seen = math.log((r.toxic + 0.5) / (p + 1) / ((r.other + 0.5) / (n + 1)))
        docs = r.toxic + r.other
        found[r.word] = max(0.0, (docs * seen + SEED_DOCS * SEED_WEIGHT) / (docs + SEED_DOCS))
    return found


def learn(docs: DataFrame, labels: DataFrame, keep: Column, sample: int = SAMPLE) -> Toxicity:
    """Learn from at most ``sample`` documents of each label for which ``keep`` (of id) holds.

    Two thirds give the lexicon: stems and words that stand in toxic documents far more often
    (so many that chance explains about one), and the weights of threats; near copies of a
    document count once. One third calibrates. Without both labels the lexicon is empty and the
    score the share of toxic documents (0 without labels).
    """
    rows = labelled(docs, labels, "toxic", keep, sample).withColumn(
        "build", F.pmod(F.xxhash64("id", F.lit(1)), F.lit(3)) > 0
    )
    counts = {(r.build, int(r.y)): r["count"] for r in rows.groupBy("build", "y").count().collect()}
    all_ = sum(counts.values())
    prior = sum(n for (_, y), n in counts.items() if y == 1) / all_ if all_ else 0.0
    if not all(counts.get((b, y)) for b in (True, False) for y in (0, 1)):
        return Toxicity({}, [], prior)
    p, n = counts[True, 1], counts[True, 0]
    rate = (F.col("toxic") + 0.5) / (p + 1), (F.col("other") + 0.5) / (n + 1)
    held = F.col("toxic") + F.col("other")
    g2 = 2 * (
        F.col("toxic") * F.log(F.col("toxic") * (p + n) / (held * p))
        + F.when(F.col("other") > 0, F.col("other") * F.log(F.col("other") * (p + n) / (held * n))).otherwise(0.0)
    )
    sure = F.col("toxic") / p / (F.col("toxic") / p + F.col("other") / n)
    build = stored(without_copies(rows.filter("build")), "build")
    stems = stored(_stem_counts(build).filter(F.col("toxic") >= LEAST_DOCS), "stems")
    # so many stems are tested that about one would pass by chance
    least_g2 = 2 * math.log(max(stems.count(), 1)) + 2
    found = (
        stems.select("stem", F.log(rate[0] / rate[1]).alias("weight"), g2.alias("g2"), sure.alias("sure"))
        .filter((F.col("g2") >= least_g2) & (F.col("sure") >= LEAST_PRECISION))
        .collect()
    )
    model = Toxicity({r.stem: r.weight for r in found}, [], prior, _threats(build, p, n))

    @F.pandas_udf("array<double>")
    def measured(texts: pd.Series) -> pd.Series:
        return texts.map(model.features)

    rest = rows.filter("not build").select("y", measured("text").alias("x")).collect()
    x, y = np.array([r.x for r in rest]), np.array([float(r.y) for r in rest])
    model.weights = logistic(x, y).tolist()
    return model


def toxicity_score(model: Toxicity, text: Column) -> Column:
    """The score of every whole text, from 0 to 1; NULL is the empty text.

    A text of any length is read clause by clause.
    """
    return scored(model.score)(text)
