"""Byte-level BPE: encoding by a priority queue of merges over a linked symbol list, and decoding."""

from __future__ import annotations

import heapq
import json
import re
from array import array

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from lakeops.llm.common import kept, map_slices, texts

#: Encoded words that a worker process keeps, and pieces between spaces; a full cache is emptied.
CACHE_ENTRIES = 1_000_000

#: Fixed value: the pattern that splits a text before merging.
SPLIT = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else one from U+0100 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


class Crowded(Exception):
    """White space meets a cut between pieces, so the text is split as a whole."""


class ByteBpe:
    """A vocabulary file of the tokenizers library with a byte-level BPE model."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        kind = (spec["pre_tokenizer"] or {}).get("type")
        plain = spec["normalizer"] is None and not model["continuing_subword_prefix"]
        if kind != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"] or not plain:
            raise ValueError(f"{path} is no plain byte-level BPE")
        vocab: dict[str, int] = model["vocab"]
        letters = byte_letters()
        code = {c: b for b, c in enumerate(letters)}
        self.start = [vocab[c] for c in letters]
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.width = 1 + max([*vocab.values(), *self.added.values()])
        self.bytes_of = [b""] * self.width
        for token, i in vocab.items():
            self.bytes_of[i] = bytes(code[c] for c in token)
        for token, i in self.added.items():
            self.bytes_of[i] = token.encode()
        #: for each left id: right id -> rank of the merge; rank -> id of the merged symbol
        none: dict[int, int] = {}
        self.rank: list[dict[int, int]] = [none] * self.width
        self.merged: list[int] = []
        for r, (a, b) in enumerate(model["merges"]):
            if self.rank[vocab[a]] is none:
                self.rank[vocab[a]] = {}
            self.rank[vocab[a]].setdefault(vocab[b], r)
            self.merged.append(vocab[a + b])
        marks = sorted(self.added, key=len, reverse=True)
        self.marks = re.compile("(" + "|".join(map(re.escape, marks)) + ")") if marks else None
        self.split = regex.compile(SPLIT)
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    def merge(self, symbols: list[int]) -> list[int]:
        """Merge neighbours in order of rank, then position.

        The queue holds rank and position in one integer; ``before`` and ``after`` link the
        symbols that are left. An entry is stale when the two symbols that now stand there
        no longer make the pair of its rank.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        ranks, merged = self.rank, self.merged
        queue = []
        left = symbols[0]
        for i in range(1, n):
            right = symbols[i]
            r = ranks[left].get(right)
            if r is not None:
                queue.append(r << 32 | i - 1)
            left = right
        if not queue:
            return symbols
        heapq.heapify(queue)
        before, after = list(range(-1, n)), list(range(1, n + 1))
        symbols.append(-1)  # stands after the last symbol and makes no pair
        while queue:
            top = heapq.heappop(queue)
            r, i = top >> 32, top & 0xFFFFFFFF
            left, j = symbols[i], after[i]
            if left < 0 or j >= n or ranks[left].get(symbols[j]) != r:
                continue
            symbols[i] = left = merged[r]
            symbols[j] = -1
            k = after[i] = after[j]
            before[k] = i
            near = ranks[left].get(symbols[k])
            if near is not None:
                heapq.heappush(queue, near << 32 | i)
            h = before[i]
            if h >= 0:
                near = ranks[symbols[h]].get(left)
                if near is not None:
                    heapq.heappush(queue, near << 32 | h)
        return [s for s in symbols if s >= 0]

    def word(self, word: str) -> bytes:
        """The ids of one split word, as little-endian unsigned 32-bit integers."""
        start = self.start
        ids = array("I", self.merge([start[b] for b in word.encode()])).tobytes()
        if len(word) <= 64:
            if len(self.words) >= CACHE_ENTRIES:
                self.words.clear()
            self.words[word] = ids
        return ids

    def split_whole(self, text: str) -> bytes:
        look, word = self.words.get, self.word
        return b"".join([look(w) or word(w) for w in self.split.findall(text)])

    def piece(self, piece: str) -> bytes:
        """The ids of a space and ``piece``, if the split always cuts before that space.

        It does between two characters that are not white space. Other pieces raise.
        """
        if not piece or piece[0].isspace() or piece[-1].isspace():
            raise Crowded
        ids = self.split_whole(" " + piece)
        if len(piece) <= 64:
            if len(self.pieces) >= CACHE_ENTRIES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def plain(self, text: str) -> bytes:
        """The ids of a text without special tokens."""
        first, *rest = text.split(" ")
        if rest and first and not first[-1].isspace():
            look, piece = self.pieces.get, self.piece
            try:
                return self.split_whole(first) + b"".join([look(p) or piece(p) for p in rest])
            except Crowded:
                pass
        return self.split_whole(text)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian unsigned 32-bit integers."""
        if self.marks is None or not self.marks.search(text):
            return self.plain(text)
        return b"".join(
            array("I", [self.added[part]]).tobytes() if part in self.added else self.plain(part)
            for part in self.marks.split(text)
        )

    def decode(self, ids: bytes) -> str:
        """The text of ids: vocabulary strings put together, bad UTF-8 replaced."""
        known = self.bytes_of
        out = b"".join([known[i] for i in np.frombuffer(ids, "<u4").tolist()])
        return out.decode("utf-8", "replace")


def load(path: str) -> ByteBpe:
    """One instance for each worker process and file."""
    return kept(path, lambda: ByteBpe(path))


def encode_documents(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"):
    """One row per input row: id, n_tokens, ids (binary) and the decoded text.

    NULL text is the empty text, which has no ids. NULL and repeated ids are kept as they
    are; other columns are not read.
    """

    def make():
        bpe = load(path)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            ids = [bpe.encode(t) for t in texts(batch, "text")]
            return pa.record_batch(
                [
                    batch.column("id"),
                    pa.array([len(x) // 4 for x in ids], pa.int64()),
                    pa.array(ids, pa.binary()),
                    pa.array([bpe.decode(x) for x in ids], pa.string()),
                ],
                ["id", "n_tokens", "ids", "decoded"],
            )

        return work

    chosen = docs.select(docs[id_col].alias("id"), docs[text_col].alias("text"))
    kind = chosen.schema["id"].dataType.simpleString()
    return map_slices(
        chosen, "text", make, f"id {kind}, n_tokens bigint, ids binary, decoded string"
    )
