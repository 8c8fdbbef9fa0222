"""Phrase mining against plain counts, with every way of counting and naming units."""

from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from lakeops.llm import collocations

SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, share=80, top=2000, scale=2_000_000):
    """Rows of (lang, text)."""
    counts, totals = {}, Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(SMALL)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for k in (1, 2, 3, 4):
                counts.setdefault(lang, Counter()).update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, f in counts.items():
        longer = Counter()
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        for p, a in found.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    longer[p[i : i + k]] = max(longer[p[i : i + k]], a)
        scored = []
        for p, a in found.items():
            if longer[p] and 100 * longer[p] >= share * a:
                continue
            score, k = min((scale * a // (f[p[:k]] + f[p[k:]]), k) for k in range(1, len(p)))
            scored.append((-score, -a, " ".join(p).encode(), f[p[:k]], f[p[k:]]))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(scored)[:top]):
            out.append((lang, rank + 1, phrase.decode(), -a, l, r, totals[lang], -score))
    return sorted(out)


def got(spark, rows, **how):
    docs = spark.createDataFrame(rows, "lang string, text string").repartition(3)
    return sorted(tuple(r) for r in collocations.collocations(docs, **how).collect())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["New", "new", "york", "city", "of", "the", "the", "a", "été", "ÉTÉ", "漢字", "x\x00y", "\x1c", "-"]
    ends = [" ", " ", " ", "  ", "\t", " ", ". ", ",", "\n", " ; ", "\x0b"]
    made = ["".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randint(0, 90))) for _ in range(120)]
    made += ["once upon a time " * rng.randint(1, 3) for _ in range(20)]
    return [(rng.choice(["en", "en", "fr", None, "und"]), t) for t in made]


@pytest.mark.parametrize("least,top", [(3, 2000), (6, 20), (10_000, 5)])
def test_phrases(spark, rows, least, top):
    assert got(spark, rows, least=least, top=top) == brute(rows, least, top=top)


def test_tiles_and_small_flushes(spark, rows, monkeypatch):
    """Dense tiles, sparse ones and ids beyond all tiles, in tasks that hold next to nothing."""
    for name, value in dict(TILE=4, TILES=2, DENSE=1, PAIRS=50, WORDS=20, BLOCK=40, BYTES=500).items():
        monkeypatch.setattr(collocations, name, value)
    assert got(spark, rows, least=3) == brute(rows, 3)
    rng = np.random.default_rng(0)
    x, y = rng.integers(0, 13, 999), rng.integers(0, 13, 999)
    found = [t for part in collocations.tile_counts(x, y) for t in zip(*(a.tolist() for a in part))]
    assert {(a, b): n for a, b, n in found} == Counter(zip(x.tolist(), y.tolist())) and len(found) == len(set(found))


def test_dictionaries_beyond_memory_are_joined(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "HELD_WORDS", 0)
    monkeypatch.setattr(collocations, "HELD_PAIRS", 0)
    assert got(spark, rows, least=3) == brute(rows, 3)


def test_odd_texts(spark, odd_docs, no_docs):
    docs = [(r.lang, r.text) for r in odd_docs.select("lang", "text").collect()]
    found = sorted(tuple(r) for r in collocations.collocations(odd_docs, least=2).collect())
    assert found == brute(docs, 2) and found
    assert collocations.collocations(no_docs).count() == 0


def test_long_text(spark):
    text = "big data . " + "one two three " * 500_000
    assert got(spark, [("en", text)], least=30) == brute([("en", text)], 30)


def test_products_beyond_64_bits(spark):
    big = 9_000_000_000_000_000_000
    df = spark.createDataFrame([(big, [big], [big])], "a long, heads array<long>, tails array<long>")
    best = df.select(collocations.best_cut(2_000_000).alias("b")).first().b
    assert best.score == 1_000_000 and best.l == big
