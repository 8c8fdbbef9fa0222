"""The n-gram join against all pairs, and its parts."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest

from lakeops.llm import ngram_join, shingles
from lakeops.llm.components import components
from lakeops.llm.ngram_join import Similarity

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def sets_of(texts, words):
    out = []
    for t in texts:
        w = (t or "").encode().translate(LOWER).split()
        out.append({tuple(w[i : i + words]) for i in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} - {()})
    return out


def brute(docs, words, percent):
    """Smallest id that links reach, by comparing all pairs."""
    ids, sets = [d for d, _ in docs], sets_of([t for _, t in docs], words)
    low = {i: i for i in ids}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = find(ids[a]), find(ids[b])
                low[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in zip(ids, sets)}


def corpus(seed, n=120):
    """Groups of near copies of many sizes, with a passage that many documents share."""
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(300)]
    passage = [f"p{i}" for i in range(12)]
    docs = []
    for g in range(n // 6):
        base = [rng.choice(words) for _ in range(rng.choice([3, 5, 8, 14, 22, 40, 90]))]
        for _ in range(6):
            own = list(base)
            for _ in range(rng.choice([0, 0, 1, 1, 2, 3])):
                own[rng.randrange(len(own))] = rng.choice(words)
            if rng.random() < 0.3:
                own = passage + own
            docs.append(" ".join(own).upper() if rng.random() < 0.2 else " ".join(own))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("words, percent, hot", [(4, 85, None), (5, 80, 0), (4, 85, 0)])
def test_all_links_are_found(spark, monkeypatch, words, percent, hot):
    if hot is not None:
        monkeypatch.setattr(ngram_join, "HOT", hot)
        monkeypatch.setattr(ngram_join, "SALTS", 2)
        monkeypatch.setattr(ngram_join, "BLOCK", 3)
        monkeypatch.setattr(ngram_join, "CHUNK", 8)
        monkeypatch.setattr(ngram_join, "BUNDLE_SETS", 5)
        monkeypatch.setattr(ngram_join, "BROADCAST_IDS", 0)
    docs = corpus(words)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = ngram_join.ngram_join(df, Similarity(words, percent)).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(docs, words, percent)


def test_ids_that_repeat_with_other_texts(spark):
    base = [f"w{i}" for i in range(40)]
    texts = {(1, " ".join(base)), (1, "z " * 9), (1, " ".join(base[:39])), (2, " ".join([*base[1:], "x"])), (2, "q r s t u")}
    df = spark.createDataFrame([*texts, *texts], "doc_id long, text string")
    got = {(r.n_shingles, r.component_id) for r in ngram_join.ngram_join(df, Similarity(4, 85)).collect()}
    assert got == {(37, 1), (36, 1), (1, 1), (2, 2)}


def test_odd_documents(odd_docs):
    got = ngram_join.ngram_join(odd_docs, Similarity(4, 85)).collect()
    assert len(got) == odd_docs.count()
    by = {r.doc_id: (r.n_shingles, r.component_id) for r in got}
    assert by[0] == (0, 0) and by[1] == (0, 1) and by[2] == (0, 2) and by[3] == (1, 3)
    assert by[7][0] == 3 and by[None] == (1, None) and by[51] == (0, 51)


def test_one_of_each_keeps_columns_and_one_of_repeated_rows(odd_docs, rows):
    kept = ngram_join.one_of_each(odd_docs, Similarity(5, 80))
    assert kept.columns == odd_docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [*range(10), 50, 51]
    assert kept.filter("doc_id is null").count() == 1


def test_no_documents(no_docs):
    assert ngram_join.ngram_join(no_docs).count() == 0
    assert ngram_join.one_of_each(no_docs).count() == 0


@pytest.mark.parametrize("segment", [1 << 20, 32])
def test_shingles(monkeypatch, segment):
    monkeypatch.setattr(shingles, "SEGMENT", segment)
    shingles._powers.clear()
    rng = random.Random(3)
    texts = [None, "", " a", "A b", "a B", "a b c d e", "\x1c x\xa0y \n z\x0bq", "é É", "y" * 100 + " z"]
    texts += ["".join(rng.choice("ab \nA\x0cé") for _ in range(rng.randint(0, 40))) for _ in range(300)]
    for words in (4, 5):
        names = {}
        found = shingles.shingle_sets(pa.array(["cut", *texts]).slice(1), words)
        for own, want in zip(found, sets_of(texts, words), strict=True):
            assert len(own) == len(want)
            assert names.setdefault(frozenset(want), own.tobytes()) == own.tobytes()
        assert len(set(names.values())) == len(names)
    shingles._powers.clear()


def test_prefixes_hold_the_first_common_elements():
    rng = random.Random(5)
    for how in (Similarity(4, 85), Similarity(5, 80)):
        for _ in range(500):
            a = set(rng.sample(range(40), rng.randint(1, 30)))
            b = {x for x in a if rng.random() < 0.95} | {x for x in range(40, 44) if rng.random() < 0.2}
            if not b or 100 * len(a & b) < how.percent * len(a | b):
                continue
            for take in (1, 2):
                if min(how.least_overlap(len(a)), how.least_overlap(len(b))) >= take:
                    first = sorted(a & b)[:take]
                    for s in (a, b):
                        assert set(first) <= set(sorted(s)[: how.prefix(len(s), take)])


def test_boundary_follows_the_cost():
    many_small = {10: 1000}
    assert ngram_join.boundary(many_small, Similarity(), 100.0) >= 10
    assert ngram_join.boundary({40: 1000}, Similarity(), 0.1) < 40


def test_components(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)]
    edges += [(100 + i, 101 + i) for i in range(40)] + [(200, 200 + i) for i in range(30)] + [(None, 1), (7, 7)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    low = {x: x for e in edges for x in e if None not in e and e[0] != e[1]}
    for _ in range(len(low)):
        for a, b in edges:
            if a in low and b in low and a != b:
                low[a] = low[b] = min(low[a], low[b])
    assert got == low
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def test_mix_is_one_to_one():
    x = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(shingles.mix(x))) == len(x)


def test_long_words_that_a_polynomial_takes_for_one():
    """A word of the Thue-Morse sequence and its complement, of two lengths."""
    for bits in (5, 6, 11, 13):
        turns = [bin(i).count("1") % 2 for i in range(1 << bits)]
        words = ["".join("ab"[t ^ flip] for t in turns) for flip in (0, 1)]
        a, b = shingles.word_hashes(pa.array(words))[0].tolist()
        assert a != b
