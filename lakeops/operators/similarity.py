"""Best match of names in a registry, by edit distance or by matching blocks.

Names that agree exactly are joined directly. For the others, all pieces of two letters are
put in one order, the rare ones first. Names at or above the threshold share so many pieces
that they share one within the first few of each, so only these rare prefixes are joined, on
(piece, length). A pair is emitted only if the piece stands at nearly the same place, enough
pieces are left after it in both orders, and the letters are nearly the same. What is left is
compared by all pieces, then by the longest common subsequence. All limits are upper bounds
for the measure, so no pair at or above the threshold is lost. (Positional q-grams: Gravano et
al., 2001; prefixes by rarity with a positional bound: Xiao et al., 2008; common subsequences
by bits: Crochemore et al., 2001.)
"""

from __future__ import annotations

from dataclasses import dataclass
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.text import name_key
from lakeops.workspace import stored

# Fixed value: least score of an accepted match.
THRESHOLD = 0.80

#: Letters of a piece. Short pieces give the strongest bound on how many are shared.
PIECE = 2

# Absorbs floating-point error in the limits; it only ever widens them.
_SLACK = 1e-9


@F.pandas_udf(T.DoubleType())
def block_ratio(left: pd.Series, right: pd.Series) -> pd.Series:
    """Twice the matched characters over the total length, as SequenceMatcher counts them."""
    return pd.Series(
        [SequenceMatcher(None, a, b).ratio() for a, b in zip(left, right, strict=True)],
        dtype="float64",
    )


@dataclass(frozen=True)
class Measure:
    """Limits that names of lengths n and m at or above the threshold must meet."""

    threshold: float = THRESHOLD

    #: Names below this threshold may share no piece.
    lowest = 0.0

    def matched(self, n: Column, m: Column) -> Column:
        """How many letters a common subsequence has at least."""
        raise NotImplementedError

    def shortest(self, n: Column) -> Column:
        raise NotImplementedError

    def longest(self, n: Column) -> Column:
        raise NotImplementedError

    def max_shift(self, n: Column, m: Column) -> Column:
        """How far apart a shared piece may be."""
        raise NotImplementedError

    def max_letters(self, n: Column, m: Column) -> Column:
        """How many letters, counted with repeats, may stand in one of the names only."""
        raise NotImplementedError

    def min_shared(self, n: Column, m: Column) -> Column:
        """How many pieces are shared at least."""
        raise NotImplementedError

    def score(self, left: Column, right: Column) -> Column:
        raise NotImplementedError


class EditSimilarity(Measure):
    """1 - edits / longer length. An edit breaks at most q pieces and changes two letters."""

    lowest = 0.5

    def matched(self, n: Column, m: Column) -> Column:
        return F.greatest(n, m) - self._edits(n, m)

    def _edits(self, n: Column, m: Column) -> Column:
        return F.floor((1 - self.threshold) * F.greatest(n, m) + _SLACK)

    def shortest(self, n: Column) -> Column:
        return F.ceil(self.threshold * n - _SLACK)

    def longest(self, n: Column) -> Column:
        return F.floor(n / self.threshold + _SLACK)

    def max_shift(self, n: Column, m: Column) -> Column:
        return self._edits(n, m)

    def max_letters(self, n: Column, m: Column) -> Column:
        return 2 * self._edits(n, m)

    def min_shared(self, n: Column, m: Column) -> Column:
        return F.greatest(n, m) + (PIECE - 1) - PIECE * self._edits(n, m)

    def score(self, left: Column, right: Column) -> Column:
        longer = F.greatest(F.length(left), F.length(right))
        return F.lit(1.0) - F.levenshtein(left, right).cast("double") / longer.cast("double")


class BlockRatio(Measure):
    """2M / T with M matched characters of T, so U = T - 2M are unmatched. The matched runs
    are separated by unmatched characters: at most U + 1 runs, each of which breaks q - 1
    pieces; markers at both ends add q - 1 pieces each."""

    lowest = 2 / 3

    def matched(self, n: Column, m: Column) -> Column:
        return F.ceil(self.threshold * (n + m) / 2 - _SLACK)

    def shortest(self, n: Column) -> Column:
        return F.ceil(n * (self.threshold / (2 - self.threshold)) - _SLACK)

    def longest(self, n: Column) -> Column:
        return F.floor(n * ((2 - self.threshold) / self.threshold) + _SLACK)

    def max_shift(self, n: Column, m: Column) -> Column:
        return F.greatest(n, m) - self.matched(n, m)

    def max_letters(self, n: Column, m: Column) -> Column:
        return n + m - 2 * self.matched(n, m)

    def min_shared(self, n: Column, m: Column) -> Column:
        return self.matched(n, m) + (PIECE - 1) - (PIECE - 1) * self.max_letters(n, m)

    def score(self, left: Column, right: Column) -> Column:
        return block_ratio(left, right)


#: Occurrences of a letter that are told apart.
LETTER_LEVELS = 4


def _letters(name: Column) -> Column:
    """Bit sets of the characters that occur at least once, twice, and so on.

    Two characters may share a bit, and occurrences beyond the last set are not told apart:
    both make names look more alike, so a limit on the difference stays an upper bound.
    """

    def add(sets: Column, char: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(char) % 64)
        levels = [sets[f"l{i}"] for i in range(LETTER_LEVELS)]
        grown = [levels[0].bitwiseOR(bit)]
        for below, level in zip(levels, levels[1:]):
            grown.append(level.bitwiseOR(below.bitwiseAND(bit)))
        return F.struct(*[g.alias(f"l{i}") for i, g in enumerate(grown)])

    empty = F.struct(*[F.lit(0).cast("long").alias(f"l{i}") for i in range(LETTER_LEVELS)])
    return F.aggregate(F.split(name, ""), empty, add)


def _different_letters(left: Column, right: Column) -> Column:
    """A lower bound of the letters, counted with repeats, that stand in one name only."""
    levels = [f"l{i}" for i in range(LETTER_LEVELS)]
    counts = [F.bit_count(left[i].bitwiseXOR(right[i])) for i in levels]
    return sum(counts[1:], counts[0])


def _cut(name: Column) -> Column:
    """All pieces of a name with a marker at both ends, in order."""
    text = F.concat(F.lit("\u0002" * (PIECE - 1)), name, F.lit("\u0003" * (PIECE - 1)))
    at = F.sequence(F.lit(1), F.length(name) + (PIECE - 1))
    return F.transform(at, lambda i: F.substring(text, i, F.lit(PIECE)))


def _ordered(pieces: DataFrame, frequency: DataFrame) -> DataFrame:
    """(name, n, letters, pos, piece, place): the place of each piece in the name's order.

    The order is the same for all names: rare pieces first, equal ones by position.
    """
    rare_first = Window.partitionBy("name").orderBy("held", "piece", "pos")
    ranked = pieces.join(frequency, "piece").withColumn("place", F.row_number().over(rare_first))
    return ranked.select("name", "n", "letters", "pos", "piece", "place")


def _prefix(n: Column, shared: Column) -> Column:
    """How many of a name's ordered pieces hold the first one that is shared."""
    return n + (PIECE - 1) - shared + 1


def candidate_pairs(names: DataFrame, registry: DataFrame, measure: Measure) -> DataFrame:
    """(name, reg_name) pairs that may reach the threshold; both inputs are distinct."""
    if measure.threshold + _SLACK < measure.lowest or measure.threshold > 1:
        raise ValueError(f"threshold {measure.threshold} is too low to find pairs by shared pieces")
    cut = [
        df.select(F.col(c).alias("name")).select(
            "name", F.length("name").alias("n"), _letters(F.col("name")).alias("letters"),
            F.posexplode(_cut(F.col("name"))).alias("pos", "piece"),
        )
        for df, c in ((names, "name"), (registry, "reg_name"))
    ]
    both = cut[0].select("piece").unionByName(cut[1].select("piece"))
    frequency = both.groupBy("piece").agg(F.count("*").alias("held"))
    n, m = F.col("n"), F.col("m")

    # a registry name's prefix for the shortest bound of all lengths it can meet
    least = F.array_min(F.transform(F.sequence(measure.shortest(m), measure.longest(m)), lambda k: measure.min_shared(k, m)))
    right = _ordered(cut[1], frequency).select(
        F.col("name").alias("reg_name"), F.col("n").alias("m"), F.col("letters").alias("reg_letters"),
        F.col("pos").alias("reg_pos"), "piece", F.col("place").alias("reg_place"),
    ).where(F.col("reg_place") <= _prefix(m, least))
    # each name looks in the few lengths where a match can be
    left = (
        _ordered(cut[0], frequency)
        .withColumn("m", F.explode(F.sequence(measure.shortest(n), measure.longest(n))))
        .withColumn("m", m.cast("int"))
        .withColumn("needed", measure.min_shared(n, m).cast("int"))
        .where(F.col("place") <= _prefix(n, F.col("needed")))
        .withColumn("max_letters", measure.max_letters(n, m))
        .withColumn("shift", measure.max_shift(n, m))
    )
    after = F.least(n - F.col("place"), right["m"] - F.col("reg_place")) + (PIECE - 1)
    condition = (
        (left["piece"] == right["piece"])
        & (left["m"] == right["m"])
        & (F.abs(F.col("pos") - F.col("reg_pos")) <= F.col("shift"))
        & (after + 1 >= F.col("needed"))
        & (_different_letters(F.col("letters"), F.col("reg_letters")) <= F.col("max_letters"))
    )
    pairs = left.join(right, condition).select("name", "reg_name").distinct()
    n, m = F.length("name"), F.length("reg_name")
    needed = measure.min_shared(n, m)

    def missing(one: str, other: str, size: Column) -> Column:
        return F.size(F.array_except(_cut(F.col(one)), _cut(F.col(other)))) <= size + (PIECE - 1) - needed

    near = pairs.where(missing("name", "reg_name", n) & missing("reg_name", "name", m))
    known = names.select(F.col("name").alias("_of"), _places(F.col("name")).alias("_places"))
    placed = near.join(known, F.col("name") == F.col("_of"))
    common = _common(F.col("_places"), n, F.col("reg_name"))
    return placed.where((n > LONGEST) | (common >= measure.matched(n, m))).select("name", "reg_name")


#: Letters of the longest name whose places fit into the bits of a number.
LONGEST = 60


def _places(name: Column) -> Column:
    """For each letter of a name, the places where it stands, as bits."""

    def bits(letter: Column) -> Column:
        add = lambda all_, i: F.when(F.substring(name, i, F.lit(1)) == letter, all_.bitwiseOR(_bit(i - 1))).otherwise(all_)
        return F.aggregate(F.sequence(F.lit(1), F.length(name)), F.lit(0).cast("long"), add)

    letters = F.array_distinct(F.split(name, ""))
    entries = F.transform(letters, lambda c: F.struct(c.alias("letter"), bits(c).alias("bits")))
    return F.when(F.length(name) <= LONGEST, F.map_from_entries(entries))


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place.cast("int"))


def _common(places: Column, n: Column, other: Column) -> Column:
    """Length of the longest common subsequence of a name (by its places) and another."""
    full = _bit(F.least(n, F.lit(LONGEST))) - 1

    def step(row: Column, letter: Column) -> Column:
        met = row.bitwiseAND(F.coalesce(F.try_element_at(places, letter), F.lit(0).cast("long")))
        return (row + met).bitwiseOR(row - met).bitwiseAND(full)

    return n - F.bit_count(F.aggregate(F.split(other, ""), full, step))


def best_match(
    rows: DataFrame,
    registry: DataFrame,
    name: str,
    reg_name: str,
    reg_id: str,
    measure: Measure,
) -> DataFrame:
    """Add ``match_id``, ``match_name`` and ``match_score`` to every row, NULL if unmatched.

    Names are compared trimmed and in lower case, each distinct name once. Equal scores go
    to the smallest id. The distinct names of both sides are stored, as several joins read
    them.
    """
    known = stored(
        registry.select(name_key(reg_name).alias("reg_name"), F.col(reg_id).alias("reg_id"))
        .where("reg_name IS NOT NULL AND reg_name <> ''")
        .groupBy("reg_name")
        .agg(F.min("reg_id").alias("reg_id")),
        "registry-names",
    )
    keyed = rows.withColumn("_name", name_key(name))
    names = stored(
        keyed.select(F.col("_name").alias("name")).where("name <> ''").distinct(), "names"
    )
    exact = names.join(known, names["name"] == known["reg_name"]).select(
        "name", "reg_id", "reg_name", F.lit(1.0).alias("score")
    )
    others = names.join(known, names["name"] == known["reg_name"], "left_anti")
    scored = (
        candidate_pairs(others, known, measure)
        .withColumn("score", measure.score(F.col("name"), F.col("reg_name")))
        .join(known, "reg_name")
        .groupBy("name")
        .agg(F.min(F.struct((-F.col("score")).alias("low"), "reg_id", "reg_name")).alias("best"))
        .select("name", "best.reg_id", "best.reg_name", (-F.col("best.low")).alias("score"))
        # here and not on the pairs, where it would be pushed below the cheaper limits
        .where(F.col("score") >= measure.threshold - _SLACK)
    )
    found = exact.unionByName(scored).select(
        F.col("name").alias("_name"),
        F.col("reg_id").alias("match_id"),
        F.col("reg_name").alias("match_name"),
        F.col("score").alias("match_score"),
    )
    return keyed.join(found, "_name", "left").drop("_name")
