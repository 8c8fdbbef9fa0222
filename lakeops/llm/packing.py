"""Packing documents into sequences: first-fit decreasing over a tournament tree of free space."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import map_slices, texts
from lakeops.llm.tokens import id_type, load

#: Documents in a randomised group, on average; groups are packed apart from each other.
GROUP_DOCS = 2048
#: Letters of text in a group, on average.
GROUP_LETTERS = 16 << 20


class Tournament:
    """Free space of bins 0..n-1; finds the first bin with room for an item."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """Put an item into the first bin that has room; all bins together always do."""
        best, node = self.best, 1
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        best[node] -= size
        bin_, node = node - self.leaves, node // 2
        while node:
            best[node] = max(best[2 * node], best[2 * node + 1])
            node //= 2
        return bin_


def first_fit_decreasing(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """The bin of each item; equal sizes in the given order."""
    tree = Tournament(max(1, len(sizes)), capacity)
    bins = np.zeros(len(sizes), np.int64)
    for i in np.argsort(-sizes, kind="stable").tolist():
        bins[i] = tree.place(int(sizes[i]))
    return bins


def _even(pieces: list[list[list[int]]], capacity: int) -> list[list[list[int]]]:
    """Fill the holes that first fit leaves, by cutting pieces of the emptiest bins.

    Bins are lists of [document, start, length]. All bins but one become full; the last one
    is cut into bins whose sizes are powers of two, which need no padding.
    """
    fill = [sum(p[2] for p in b) for b in pieces]
    order = sorted(range(len(pieces)), key=lambda i: (-fill[i], i))
    lo, hi = 0, len(order) - 1
    while lo < hi:
        taker, giver = order[lo], order[hi]
        room = capacity - fill[taker]
        if room == 0:
            lo += 1
            continue
        while room and pieces[giver]:
            doc, start, length = pieces[giver][-1]
            cut = min(room, length)
            pieces[taker].append([doc, start + length - cut, cut])
            if cut == length:
                pieces[giver].pop()
            else:
                pieces[giver][-1][2] -= cut
            room -= cut
            fill[taker] += cut
            fill[giver] -= cut
        if not pieces[giver]:
            hi -= 1
    out = [b for b in pieces if b and sum(p[2] for p in b) == capacity]
    for rest in (b for b in pieces if b and sum(p[2] for p in b) < capacity):
        left = sum(p[2] for p in rest)
        while left:
            size = 1 << (left.bit_length() - 1)
            part, room = [], size
            while room:
                doc, start, length = rest[0]
                cut = min(room, length)
                part.append([doc, start, cut])
                rest[0] = [doc, start + cut, length - cut]
                if cut == length:
                    rest.pop(0)
                room -= cut
            out.append(part)
            left -= size
    return out


def plan(lengths: list[int], capacity: int) -> list[list[list[int]]]:
    """Bins of [document, start, length] that hold every position of every document once.

    Whole capacities are cut off each document first; what is left of each is placed by
    first-fit decreasing, and the last holes are filled by cuts.
    """
    full, rest = [], []
    for doc, n in enumerate(lengths):
        whole = n - n % capacity
        full += [[[doc, s, capacity]] for s in range(0, whole, capacity)]
        if n > whole:
            rest.append([doc, whole, n - whole])
    bins = first_fit_decreasing(np.array([r[2] for r in rest], np.int64), capacity)
    packed: list[list[list[int]]] = [[] for _ in range(int(bins.max()) + 1 if len(rest) else 0)]
    for r, b in zip(rest, bins.tolist()):
        packed[b].append(r)
    return full + _even(packed, capacity)


def encode(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str, groups: int):
    """(doc_id, group, start, ids, doc_tokens): each text's ids and ``end_id``, cut at capacities.

    The random group hashes the row's place in the scan and the piece's, so that repeated
    rows, ids, and the pieces of a long text spread over all groups.
    """

    def make():
        coder = load(path)
        end = np.array([end_id], coder.dtype).tobytes()
        width = len(end)

        def work(batch: pa.RecordBatch) -> pa.RecordBatch:
            doc_ids, places = batch.column("doc_id").to_pylist(), batch.column("place").to_numpy()
            rows = []
            for doc, place, ids in zip(doc_ids, places.tolist(), coder.encode(texts(batch, "text"))):
                ids += end
                for at in range(0, len(ids), capacity * width):
                    piece = at // (capacity * width)
                    rows.append((doc, (place + piece * 0x9E3779B1) % groups, at // width, ids[at : at + capacity * width], len(ids) // width))
            columns = list(zip(*rows)) or [()] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64()]
            names = ["doc_id", "group", "start", "ids", "doc_tokens"]
            return pa.record_batch([pa.array(c, k) for c, k in zip(columns, kinds)], names)

        return work

    chosen = docs.select(
        docs[id_col].cast("long").alias("doc_id"),
        docs[text_col].alias("text"),
        F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(1 << 31)).alias("place"),
    )
    return map_slices(chosen, "text", make, "doc_id bigint, group bigint, start bigint, ids binary, doc_tokens bigint")


def pack(
    docs: DataFrame,
    path: str,
    capacity: int = 2048,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    group_docs: int = GROUP_DOCS,
    group_letters: int = GROUP_LETTERS,
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids, doc_tokens, sequence_id, offset.

    Every text is encoded, ``end_id`` is added, and the ids are cut into pieces that lie in
    sequences of at most ``capacity`` ids. Each group has full sequences, and a rest in
    sequences whose sizes are powers of two. ``ids`` are little-endian unsigned 32-bit
    integers. Sequence ids are unique: the group's number and a number within it.

    NULL and empty texts are the end id alone. Repeated rows are packed each; NULL ids stay
    NULL. No documents give no pieces. A text is cut at capacities before it is dealt out, so
    a long one spreads over the groups; a task that encodes it holds its ids. Groups hold the
    pieces of ``group_docs`` documents and ``group_letters`` letters at most on average. They
    depend on the rows' places in the scan: reruns over the same files agree.
    """
    size = docs.agg(F.count("*"), F.sum(F.length(docs[text_col]).cast("long"))).first()
    groups = max(1, -(-size[0] // group_docs), -(-(size[1] or 0) // group_letters))
    coded = encode(docs, path, capacity, end_id, id_col, text_col, groups)
    dtype = id_type(path)

    def run(key, rows):
        doc_ids, starts, of = (rows.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
        ids = [np.frombuffer(x, dtype) for x in rows.column("ids").to_pylist()]
        bins = plan([len(x) for x in ids], capacity)
        flat = [(d, s, n, b) for b, pieces in enumerate(bins) for d, s, n in pieces]
        offsets = [o for pieces in bins for o in _running([n for _, _, n in pieces])]
        base = key[0].as_py() << 32
        return pa.table(
            {
                "doc_id": pa.array([doc_ids[d] for d, _, _, _ in flat], pa.int64()),
                "start": pa.array([starts[d] + s for d, s, _, _ in flat], pa.int64()),
                "length": pa.array([n for _, _, n, _ in flat], pa.int64()),
                "ids": pa.array([ids[d][s : s + n].astype("<u4").tobytes() for d, s, n, _ in flat], pa.binary()),
                "doc_tokens": pa.array([of[d] for d, _, _, _ in flat], pa.int64()),
                "sequence_id": pa.array([base + b for _, _, _, b in flat], pa.int64()),
                "offset": pa.array(offsets, pa.int64()),
            }
        )

    return coded.groupBy("group").applyInArrow(
        run,
        "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint,"
        " sequence_id bigint, offset bigint",
    )


def _running(lengths: list[int]) -> list[int]:
    """Sums of the lengths before each."""
    out, at = [], 0
    for n in lengths:
        out.append(at)
        at += n
    return out
