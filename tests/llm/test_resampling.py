"""Importance resampling against the same sums in plain Python."""

from __future__ import annotations

import hashlib
import math
import random
import re
from collections import Counter
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeops.llm import resampling
from lakeops.llm.common import numbered

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SMALL = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bag(text, buckets=10_000):
    words = WORD.findall((text or "").translate(SMALL))
    names = words + [f"{a} {b}" for a, b in zip(words, words[1:])]
    return len(words), [crc32(x.encode()) % buckets for x in names]


def brute(docs, target, percent=25, buckets=10_000, least_words=20):
    bags = [(i, *bag(t, buckets)) for i, t in docs]
    s = Counter(b for _, _, x in bags for b in x)
    t = Counter(b for text in target for b in bag(text, buckets)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets)))) for b in s}
    out = []
    for i, words, x in bags:
        weight = sum(gain[b] for b in x) // len(x) if x else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(x), weight, score, None, words])
    able = sorted((r for r in out if r[5] >= least_words), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(able[: percent * len(able) // 100]):
        r[4] = rank + 1
    return sorted((tuple(r[:5]) for r in out), key=key)


def key(row):
    return [(v is None, v) for v in row]


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=key)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    words = ["apple", "Pear", "ÉTÉ", "été", "x1", "漢字", "of", "the", "a"]
    return [(i, " ,".join(rng.choice(words[: 2 + i % 8]) for _ in range(rng.randint(0, 60)))) for i in range(300)]


TARGET = ["the apple of x1 été", "of the", None, ""]


def frames(spark, rows, target=TARGET):
    return (
        spark.createDataFrame(rows, "doc_id long, text string"),
        spark.createDataFrame([(t,) for t in target], "text string"),
    )


@pytest.mark.parametrize("percent", [0, 1, 25, 100])
def test_draw(spark, rows, percent):
    docs, target = frames(spark, rows)
    assert got(resampling.resample(docs, target, percent=percent)) == brute(rows, TARGET, percent)


def test_odd_texts(spark, odd_docs, no_docs):
    target = spark.createDataFrame([("a b c",)], "text string")
    want = brute([(r.doc_id, r.text) for r in odd_docs.select("doc_id", "text").collect()], ["a b c"], percent=50)
    assert got(resampling.resample(odd_docs, target, percent=50)) == want
    assert resampling.resample(no_docs, target).count() == 0
    assert resampling.resample(odd_docs, target.limit(0)).count() == odd_docs.count()


def test_repeated_rows_and_missing_ids_at_the_cutoff(spark, rows):
    """Rows of one id and score are ranked each, and no more are drawn than asked for."""
    text = " ".join(["apple"] * 30)
    for repeated in ([(7, text)] * 40, [(None, text)] * 40, [(7, text)] * 20 + [(None, text)] * 20):
        docs, target = frames(spark, repeated)
        assert got(resampling.resample(docs, target)) == brute(repeated, TARGET)


def test_texts_cut_into_blocks(spark, rows, monkeypatch):
    long_ = [(1, " ".join(t for _, t in rows))]
    monkeypatch.setattr(resampling, "BLOCK", 50)
    found = list(resampling.features(long_[0][1].encode(), 997))
    assert len(found) > 50
    words, want = bag(long_[0][1], 997)
    assert sorted(np.concatenate([f for f, _ in found]).tolist()) == sorted(want)
    assert sum(n for _, n in found) == words


def test_long_text(spark):
    docs, target = frames(spark, [(1, "word and other " * 1_400_000), (2, "word " * 25)])
    first = got(resampling.resample(docs, target, percent=100))[0]
    assert first[1] == 2 * 4_200_000 - 1 and first[4] in (1, 2)


def test_counts_find_the_cutoff(spark, monkeypatch):
    monkeypatch.setattr(resampling, "THRESHOLDS", 2)
    scores = [5, 5, 5, 1, 9, -300, 5, 7]
    df = spark.createDataFrame(list(enumerate(scores)), "doc_id long, score long")
    for draw in range(1, 9):
        cut = resampling.cutoff(df, draw)
        want = sorted(enumerate(scores), key=lambda r: (-r[1], r[0]))[:draw]
        assert sorted(r.doc_id for r in df.filter(cut.drawn()).collect()) == sorted(i for i, _ in want)


def test_numbers_follow_the_order(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1009).alias("v"), "id").repartition(9)
    rows = numbered(df, [F.desc("v"), F.asc("id")]).collect()
    want = sorted(rows, key=lambda r: (-r.v, r.id))
    assert [r.number for r in want] == list(range(1000))
    assert numbered(df.limit(0), [F.asc("v")]).count() == 0
