"""Name matching against brute force."""

from __future__ import annotations

import random
from difflib import SequenceMatcher

import pytest

from pyspark.sql import functions as F

from lakeops.operators.similarity import BlockRatio, EditSimilarity, _common, _places, best_match, candidate_pairs


def edit_similarity(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return 1 - row[-1] / max(len(a), len(b))


def block_similarity(a, b):
    return SequenceMatcher(None, a, b).ratio()


MEASURES = [(BlockRatio, block_similarity), (EditSimilarity, edit_similarity)]


@pytest.fixture(scope="module")
def names():
    """Short alphabet, so that many names are nearly the same."""
    rng = random.Random(3)
    letters = "abcdeé "

    def name():
        return "".join(rng.choice(letters) for _ in range(rng.randint(1, 16))).strip() or "a"

    registry = sorted({name() for _ in range(200)})
    asked = {name() for _ in range(80)}
    for known in registry:
        chars = list(known)
        for _ in range(rng.randint(0, 4)):
            at, kind = rng.randrange(len(chars) + 1), rng.random()
            if kind < 0.4 and chars:
                chars.pop(min(at, len(chars) - 1))
            elif kind < 0.7:
                chars.insert(at, rng.choice(letters))
            elif chars:
                chars[min(at, len(chars) - 1)] = rng.choice(letters)
        asked.add("".join(chars).strip())
    return sorted(asked - {""}), registry


@pytest.mark.parametrize("threshold", [0.7, 0.8, 0.9])
@pytest.mark.parametrize(("measure", "similarity"), MEASURES)
def test_no_pair_is_lost(spark, names, measure, similarity, threshold):
    asked, registry = names
    got = candidate_pairs(
        spark.createDataFrame([(n,) for n in asked], "name string"),
        spark.createDataFrame([(n,) for n in registry], "reg_name string"),
        measure(threshold),
    )
    found = {tuple(r) for r in got.collect()}
    wanted = {(a, b) for a in asked for b in registry if similarity(a, b) >= threshold - 1e-9}
    assert wanted and wanted <= found
    assert len(found) < len(asked) * len(registry) / 2


@pytest.mark.parametrize(("measure", "similarity"), MEASURES)
def test_best_match_equals_brute_force(spark, names, measure, similarity):
    asked, registry = names
    ids = {name: (i * 37) % 101 for i, name in enumerate(registry)}
    got = best_match(
        spark.createDataFrame([(f" {n.upper()} ",) for n in asked], "who string"),
        spark.createDataFrame([(n, ids[n]) for n in registry], "known string, id int"),
        "who", "known", "id", measure(),
    )
    for row in got.collect():
        name = row.who.strip().lower()
        scores = [(-similarity(name, r), ids[r], r) for r in registry]
        low, best_id, _ = min(scores)
        if -low >= 0.8 - 1e-9:
            assert (row.match_id, row.match_score) == (best_id, pytest.approx(-low))
        else:
            assert row.match_id is None and row.match_name is None


def test_players(spark, rows):
    salaries = spark.createDataFrame(
        [("Santi Aldama", 1), ("Jaime Jaquez Jr.", 2), ("Nene", 3), (None, 4), ("Zzz Qqq", 5), ("Nene", 6)],
        "fullname string, row int",
    )
    registry = spark.createDataFrame(
        [(9, "Santiago Aldama"), (4, "Jaime Jaquez"), (5, "nene "), (3, "Nene"), (8, None)],
        "id int, name string",
    )
    got = best_match(salaries, registry, "fullname", "name", "id", BlockRatio())
    assert rows(got, "row", "match_id", "match_name") == [
        (1, 9, "santiago aldama"), (2, 4, "jaime jaquez"), (3, 3, "nene"),
        (4, None, None), (5, None, None), (6, 3, "nene"),
    ]
    nobody = best_match(salaries, registry.limit(0), "fullname", "name", "id", BlockRatio())
    assert nobody.where("match_id is not null").count() == 0 and nobody.count() == 6


def common(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        new = [0]
        for j, y in enumerate(b):
            new.append(row[j] + 1 if x == y else max(new[-1], row[j + 1]))
        row = new
    return row[-1]


def test_common_subsequences(spark, names):
    asked, registry = names
    pairs = [(a, b) for a in [*asked[:40], "x" * 60, "ab" * 30] for b in [*registry[:40], "xa" * 50]]
    df = spark.createDataFrame(pairs, "a string, b string")
    got = df.select("a", "b", _common(_places(F.col("a")), F.length("a"), F.col("b")).alias("k")).collect()
    assert all(r.k == common(r.a, r.b) for r in got)


@pytest.mark.parametrize(("measure", "similarity"), MEASURES)
def test_scored_pairs_of_common_first_names(spark, measure, similarity):
    """A third of the people have one first name: at 4,000, 1.8 million pairs share it. What is
    scored stays below two pairs a person.
    """
    rng = random.Random(8)

    def people(n):
        last = ["".join(rng.choice("aabcdeefghiiklmnoprstuvz") for _ in range(rng.randint(6, 10))) for _ in range(n)]
        first = ["michael" if i % 3 == 0 else "".join(rng.choice("abcdefghijklmnopr") for _ in range(7)) for i in range(n)]
        return sorted({f"{a} {b}" for a, b in zip(first, last)})

    scored = []
    for n in (1000, 2000, 4000):
        registry = people(n)
        asked = sorted({x[:9] + x[10:] for x in registry})
        pairs = candidate_pairs(
            spark.createDataFrame([(x,) for x in asked], "name string"),
            spark.createDataFrame([(x,) for x in registry], "reg_name string"),
            measure(0.8),
        )
        scored.append(pairs.count())
        assert n - 10 <= scored[-1] <= 2 * n


def test_long_names(spark):
    long_ = "ab cd " * 15
    asked = [long_, long_[:-3] + "xyz", "short"]
    got = best_match(
        spark.createDataFrame([(x,) for x in asked], "who string"),
        spark.createDataFrame([(long_ + "q", 1), ("shorty", 2)], "known string, id int"), "who", "known", "id", BlockRatio(),
    )
    assert sorted(r.match_id for r in got.collect()) == [1, 1, 2]


def test_low_threshold_is_refused(spark):
    empty = spark.createDataFrame([], "name string, reg_name string")
    with pytest.raises(ValueError, match="too low"):
        candidate_pairs(empty, empty, BlockRatio(0.5))
