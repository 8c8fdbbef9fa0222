"""BPE, packing and token totals against the tokenizers library and plain sums."""

from __future__ import annotations

import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeops.llm import bpe, packing, token_counts, tokens
from lakeops.workspace import new_folder
from tests.llm.conftest import ODD

BYTE, WORD = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "word_bpe_49k.json"))
LETTERS = " \n\t ab'sTé1٣,.漢🙂​́\x1c\x85İΣ"


@pytest.fixture(scope="module")
def strange():
    rng = random.Random(4)
    made = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 30))) for _ in range(800)]
    marks = ["<|endoftext|>", "<|startoftext|>", " <|endoftext|>", "<|endoftext"]
    return [t or "" for t in ODD] + made + [a + rng.choice(marks) + b for a, b in zip(made, made[1:])]


def test_byte_bpe(strange):
    own, their = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    for text, want in zip(strange, their.encode_batch(strange, add_special_tokens=False)):
        ids = own.encode(text)
        assert np.frombuffer(ids, "<u4").tolist() == want.ids
        assert own.decode(ids) == their.decode(want.ids, skip_special_tokens=False)


def test_merges_of_long_words():
    own, their = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    rng = random.Random(1)
    word = "".join(rng.choice("abeinrst") for _ in range(20_000))
    assert np.frombuffer(own.encode(word), "<u4").tolist() == their.encode(word, add_special_tokens=False).ids


def test_full_caches_are_emptied(monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_ENTRIES", 3)
    own, their = bpe.ByteBpe(BYTE), Tokenizer.from_file(BYTE)
    text = "the quick brown fox jumps over the lazy dog the quick end"
    assert np.frombuffer(own.encode(text), "<u4").tolist() == their.encode(text).ids


def test_other_vocabularies_are_refused():
    with pytest.raises(ValueError):
        bpe.ByteBpe(WORD)


@pytest.mark.parametrize("most", [64 << 20, 4000])
@pytest.mark.parametrize("path", [BYTE, WORD])
def test_pieces(strange, path, most, monkeypatch):
    monkeypatch.setattr(tokens, "CACHE_BYTES", most)
    monkeypatch.setattr(tokens, "BLOCK", 500 if most < 5000 else tokens.BLOCK)
    own, their = tokens.PieceEncoder(path), Tokenizer.from_file(path)
    for ids, want in zip(own.encode(strange), their.encode_batch(strange, add_special_tokens=False)):
        assert np.frombuffer(ids, own.dtype).tolist() == want.ids


def test_encoded_documents(odd_docs, no_docs):
    got = {r.id: r for r in bpe.encode_documents(odd_docs, BYTE).collect()}
    assert got[0].n_tokens == 0 and got[0].ids == b"" and got[0].decoded == "" and got[51].n_tokens == 0
    assert all(got[i].decoded == t for i, t in enumerate(ODD) if t)
    assert bpe.encode_documents(odd_docs, BYTE).count() == odd_docs.count()
    assert bpe.encode_documents(no_docs, BYTE).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_first_fit_decreasing(seed):
    rng = np.random.default_rng(seed)
    sizes = rng.integers(1, 100, rng.integers(1, 80))
    free: list[int] = []
    want = np.zeros(len(sizes), int)
    for i in np.argsort(-sizes, kind="stable"):
        at = next((b for b, room in enumerate(free) if room >= sizes[i]), len(free))
        if at == len(free):
            free.append(100)
        free[at] -= sizes[i]
        want[i] = at
    assert packing.first_fit_decreasing(sizes, 100).tolist() == want.tolist()


@pytest.mark.parametrize("lengths", [[], [1], [64], [65, 1, 200], list(range(1, 150)), [63] * 40, [1] * 200])
def test_plan(lengths):
    seen = {d: [] for d in range(len(lengths))}
    sizes = []
    for pieces in packing.plan(lengths, 64):
        sizes.append(sum(n for _, _, n in pieces))
        for d, s, n in pieces:
            assert n > 0
            seen[d] += range(s, s + n)
    assert all(sorted(seen[d]) == list(range(n)) for d, n in enumerate(lengths))
    assert all(s <= 64 and s & (s - 1) == 0 for s in sizes)  # full, or a power of two
    assert sum(s < 64 for s in sizes) <= 6


def test_packed_documents(odd_docs, no_docs):
    pieces = packing.pack(odd_docs, WORD, capacity=64, group_docs=5).collect()
    their = Tokenizer.from_file(WORD)
    whole = {}
    for p in sorted(pieces, key=lambda p: p.start):
        whole.setdefault((p.doc_id, p.doc_tokens), []).append(p)
    for i, t in enumerate(ODD):
        ids = their.encode(t or "", add_special_tokens=False).ids + [1]
        held = b"".join(p.ids for p in whole[i, len(ids)] if i != 4)
        assert i == 4 or np.frombuffer(held, "<u4").tolist() == ids
    assert sum(p.length for p in whole[4, 3]) == 6  # the repeated row is packed twice
    assert (None, 5) in whole
    by: dict = {}
    for p in pieces:
        by.setdefault(p.sequence_id, []).append((p.offset, p.length))
    for parts in by.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64 and at & (at - 1) == 0
    assert packing.pack(no_docs, WORD).count() == 0


def test_totals_follow_changes(spark, odd_docs, rows):
    totals = token_counts.TokenTotals(spark, new_folder(spark, "totals"))
    counts = token_counts.counted(odd_docs, WORD, "v1")
    totals.commit("load", token_counts.inserts(counts))
    want = rows(counts.groupBy("source", "lang", "tokenizer").agg(F.count("*"), F.sum("n_tokens")))
    assert rows(totals.totals()) == want
    totals.commit("load", token_counts.inserts(counts))  # the same batch again
    assert rows(totals.totals()) == want
    part = counts.filter("lang = 'en'")
    newer = part.withColumn("tokenizer", F.lit("v2")).withColumn("n_tokens", F.col("n_tokens") + 1)
    totals.commit("revise", token_counts.revisions(part, newer))
    state = counts.filter("lang is null or lang <> 'en'").unionByName(newer)
    want = rows(state.groupBy("source", "lang", "tokenizer").agg(F.count("*"), F.sum("n_tokens")))
    assert rows(totals.totals()) == want
    totals.commit("clear", token_counts.deletes(state))
    totals.commit("nothing", token_counts.inserts(counts.limit(0)))
    assert totals.totals().count() == 0
    with pytest.raises(ValueError):
        totals.commit("a/b", token_counts.inserts(counts))


def test_words_of_plain_text_are_the_models(strange):
    """ASCII and Latin-1 letters in any order, with contractions, digits, signs and special tokens."""
    rng = random.Random(9)
    signs = [*"aZéÀÖ×÷ßÿ0192'.,-\"!<|> \t\n\x0b\x1c", "'s", "n't", "<|endoftext|>", "'LL", "Ø", "\x7f", "ª", "İ", "e\u0301"]
    made = ["".join(rng.choice(signs) for _ in range(rng.randint(0, 60))) for _ in range(3000)]
    own, their = tokens.PieceEncoder(WORD), Tokenizer.from_file(WORD)
    for ids, want in zip(own.encode(made), their.encode_batch(made, add_special_tokens=False)):
        assert np.frombuffer(ids, own.dtype).tolist() == want.ids


def test_caches_keep_what_is_used_and_stay_small():
    kept = tokens.Kept(20 * (tokens.ENTRY + 10))
    for i in range(1000):
        for k in kept.missing({"often", f"w{i}"}):
            kept.add(k, b"12")
        assert "often" in kept.new and len(kept.new) + len(kept.old) <= 24
        kept.tidy()


def test_long_text_is_cut_into_pieces_that_spread(spark):
    text = "Some words, of one very long text. " * 600_000
    docs = spark.createDataFrame([(1, text), (2, "short")], "doc_id long, text string")
    pieces = packing.pack(docs, WORD)
    got = pieces.drop("ids").collect()
    want = len(tokens.PieceEncoder(WORD).encode([text])[0]) // 2 + 1
    own = sorted((r.start, r.length) for r in got if r.doc_id == 1)
    assert sum(n for _, n in own) == want == max(r.doc_tokens for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(own, own[1:]))
    groups = {r.sequence_id >> 32 for r in got}
    assert len(groups) == 2  # by letters, as there are two documents


def test_pieces_are_encoded_once():
    """Pieces between white space are looked up whole: words are split off only in pieces not seen yet."""
    own, their, made = tokens.PieceEncoder(WORD), Tokenizer.from_file(WORD), []
    make = own.kept.make
    own.kept.make = lambda piece: made.append(piece) or make(piece)
    parts = ["The", "cat,", "CAT.", "Été", "été,", "don't", "<|endoftext|>", "漢字", "a1."]
    for ids, want in zip(own.encode([" ".join(parts)] * 50), their.encode_batch([" ".join(parts)] * 50, add_special_tokens=False)):
        assert np.frombuffer(ids, own.dtype).tolist() == want.ids
    assert len(made) == len(set(made)) and {p.encode() for p in parts} <= set(made)
    own.encode(["x" * 100] * 2)  # a long piece is not kept
    assert made[-2:] == [b"x" * 100] * 2 and b"x" * 100 not in own.kept.new
