"""Entropy balancing against a plain solution of the same problem, document by document."""

from __future__ import annotations

import math
import re

import pytest
from pyspark.sql import functions as F

from lakeops.llm import mixing

SF_DIR = "/root/testdata/sf0.001"


def plain_targets(sizes, pattern=(5, 2, 1), limit=3):
    """Water filling: sources in order, NULL last."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: pattern[i % len(pattern)] for i, s in enumerate(order)}
    total, full = sum(sizes.values()), set()
    while True:
        open_ = sum(weight[s] for s in order if s not in full)
        rest = total - sum(limit * sizes[s] for s in full)
        level = rest / open_ if open_ else 0.0
        over = {s for s in order if s not in full and weight[s] * level > limit * sizes[s]}
        if not over:
            return {s: limit * sizes[s] if s in full else weight[s] * level for s in order}
        full |= over


def plain_rates(sizes, target, limit=3):
    """Rates exp(t x) cut at the limit whose words are the target, by halving."""
    low, high = -1e4, 1e4

    def words(t):
        return sum(n * math.exp(min(t * n / mean, math.log(limit))) for n in sizes if n)

    mean = sum(sizes) / sum(n > 0 for n in sizes)
    for _ in range(200):
        t = (low + high) / 2
        low, high = (t, high) if words(t) < target else (low, t)
    return [math.exp(min(t * n / mean, math.log(limit))) if n else 0.0 for n in sizes]


def checked(rows, pattern=(5, 2, 1), near=0.02):
    """All that a mix promises: targets, optimal rates, whole copies, no document over its limit."""
    by = {}
    for r in rows:
        by.setdefault(r.source, []).append(r)
    sizes = {s: sum(r.size for r in rs) for s, rs in by.items()}
    targets = plain_targets(sizes, pattern)
    for s, rs in by.items():
        assert {r.source_size for r in rs} == {sizes[s]}
        assert all(math.isclose(r.target, targets[s], rel_tol=1e-9, abs_tol=1e-9) for r in rs)
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r in rs)
        assert abs(sum(r.taken for r in rs) - targets[s]) <= max(near * targets[s], 1 + max(r.size for r in rs) / 2)
        if 0 < targets[s] < 3 * sizes[s] * (1 - 1e-9):
            want = plain_rates([r.size for r in rs], targets[s])
            assert [r.rate for r in rs] == pytest.approx(want, rel=1e-5, abs=1e-6)
    return by


def test_mix_of_the_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = mixing.mix(docs).collect()
    checked(rows, near=0.05)
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert all(r.size == len(re.findall(r"[^ \t-\r]+", texts[r.doc_id] or "")) for r in rows)
    # the rows' order and the number of tasks change nothing
    again = mixing.mix(docs.repartition(7, "n_chars")).collect()
    assert sorted((r.doc_id, r.taken) for r in again) == sorted((r.doc_id, r.taken) for r in rows)


def made(spark, sources):
    rows, i = [], 0
    for s, sizes in sources.items():
        for n in sizes:
            rows.append((i, " ".join(["w"] * n), s))
            i += 1
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_targets_stop_at_three_times_the_size(spark):
    docs = made(spark, {"a": [1, 2, 3], "b": [400, 1, 7] * 20, "c": [5] * 9, None: [100, 50, 3], "d": []})
    by = checked(mixing.mix(docs).collect(), near=0.001)
    assert sum(r.taken for r in by["a"]) == 18 == by["a"][0].target


def test_one_long_document_among_short_ones(spark):
    docs = made(spark, {"a": [5000] + [1] * 3000, "b": [2] * 4000, "c": [0, 0, 0]})
    by = checked(mixing.mix(docs).collect(), near=1e-6)
    assert sum(r.taken for r in by["a"]) == round(by["a"][0].target)
    assert all(r.taken == 0 and r.target == 0 for r in by["c"])


def test_odd_texts(spark, odd_docs, no_docs):
    rows = mixing.mix(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    checked(rows, near=0.2)
    assert mixing.mix(no_docs).count() == 0
    only_empty = spark.createDataFrame([(1, "", "a"), (2, None, None)], "doc_id long, text string, source string")
    assert [(r.size, r.taken) for r in mixing.mix(only_empty).collect()] == [(0, 0)] * 2


def test_equal_sizes_are_dealt_over_parts(spark):
    docs = made(spark, {"a": [3] * 2000, "b": [3] * 50})
    checked(mixing.mix(docs).collect(), near=1e-3)


def test_long_text(spark):
    docs = made(spark, {"a": [2_000_000, 10, 10], "b": [1_000_000] * 2})
    checked(mixing.mix(docs).collect(), near=0.5)


def test_size_counts_words_in_the_scan(spark):
    plan = mixing.sized(spark.range(1).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("s").alias("source")))
    assert "Python" not in plan._jdf.queryExecution().executedPlan().toString()
