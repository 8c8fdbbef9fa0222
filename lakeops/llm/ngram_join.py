"""Jaccard join of documents on word n-grams: a size-aware heavy-light join."""

from __future__ import annotations

import math
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeops.llm.common import begin, give_back, slices
from lakeops.llm.components import components, stars
from lakeops.llm.shingles import mix, set_id, shingle_sets
from lakeops.workspace import stored

#: Counters of shingles (one byte each, stopping at 255) and of words (four bytes each), and
#: blocks in which they are added up.
SHINGLES, WORDS, BLOCKS = 1 << 24, 1 << 20, 64
#: Text bytes that a task turns into sets at once.
SLICE = 1 << 20
#: Elements in a subset of a light set.
SUBSET = 2
#: A list whose counter is above this is dealt out over SALTS groups.
HOT, SALTS = 250, 64
#: Documents to be compared are broadcast by id up to this number, and joined beyond.
BROADCAST_IDS = 500_000
#: Sets and elements of a block; blocks are compared two at a time, in chunks of so many
#: shared elements.
BLOCK, BLOCK_ELEMENTS, CHUNK = 1024, 1 << 19, 2048
#: Sets of small pairs of blocks that one call compares, about.
BUNDLE_SETS = 256


@dataclass(frozen=True)
class Similarity:
    """Sets link when 100 * intersection >= percent * union."""

    words: int = 4
    percent: int = 85

    def least_overlap(self, size: int) -> int:
        """What a set of this size shares with any set it links to: its smallest partner."""
        return -(-self.percent * size // 100)

    def prefix(self, size: int, take: int) -> int:
        """Linked sets share their ``take`` first common elements within such prefixes."""
        return size - self.least_overlap(size) + take

    def near(self, both: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """From sizes of intersections and of the sets."""
        return (both > 0) & (100 * both >= self.percent * (a + b - both))


def boundary(sizes: dict[int, int], how: Similarity, scan: float) -> int:
    """The largest light size, chosen by cost.

    A light set writes one row per subset of its prefix; a heavy set writes one row per
    prefix element and reads ``scan`` further entries of each list. Light sets near the
    boundary are also in the lists, for heavy partners.
    """

    def light(s: int) -> float:
        return math.comb(how.prefix(s, SUBSET), SUBSET) if how.least_overlap(s) >= SUBSET else 0

    def heavy(s: int) -> float:
        return how.prefix(s, 1) * (1 + scan)

    def cost(x: int) -> float:
        reach = how.least_overlap(x + 1)
        return sum(
            n * ((light(s) if s <= x else 0) + (heavy(s) if s >= reach else 0)) for s, n in sizes.items()
        )

    return min(range(1, 65), key=cost)


def _sets(batch: pa.RecordBatch, words: int, each=None):
    """The set of each row of a batch, from pieces of about a MB or one text."""
    for piece in slices(batch, "text", SLICE):
        yield from shingle_sets(piece.column("text"), words, each)


def _counter(hashes: np.ndarray, counters: int) -> np.ndarray:
    """The counter of each hash."""
    return (hashes >> np.uint64(64 - counters.bit_length() + 1)).astype(np.int64)


def _survey(docs: DataFrame, how: Similarity) -> DataFrame:
    """Rows of kind 0: each document's set size and set id; of kind 1: blocks of counters.

    Those of kind 1 hold in how many documents each shingle stands, those of kind 2 how often
    each word does, both added up by hash.
    """

    def run(batches):
        begin(__name__)
        counts, words = np.zeros(SHINGLES, np.uint8), np.zeros(WORDS, np.uint32)

        def each(hashes: np.ndarray) -> None:
            words[:] += np.bincount(_counter(hashes, WORDS), minlength=WORDS).astype(np.uint32)

        task = TaskContext.get().partitionId()
        for batch in batches:
            n, ids, pending, held = [], [], [], 0
            for own in _sets(batch, how.words, each):
                n.append(len(own))
                ids.append(set_id(own) if len(own) else None)
                pending.append(own)
                held += len(own)
                if held > 1 << 18:
                    _add(counts, pending)
                    pending, held = [], 0
            _add(counts, pending)
            size = batch.num_rows
            yield pa.record_batch(
                [
                    pa.array([0] * size, pa.int32()),
                    batch.column("doc_id"),
                    pa.array(n, pa.int64()),
                    pa.array(ids, pa.int64()),
                    pa.nulls(size, pa.int32()),
                    pa.nulls(size, pa.binary()),
                ],
                ["kind", "doc_id", "n", "id", "block", "counts"],
            )
        for kind, held in ((1, counts), (2, words)):
            parts = held.reshape(BLOCKS, -1)
            some = [b for b in range(BLOCKS) if parts[b].any()]
            yield pa.record_batch(
                [
                    pa.array([kind] * len(some), pa.int32()),
                    pa.array([task // 256] * len(some), pa.int64()),
                    pa.nulls(len(some), pa.int64()),
                    pa.nulls(len(some), pa.int64()),
                    pa.array(some, pa.int32()),
                    pa.array([_packed(parts[b]) for b in some], pa.binary()),
                ],
                ["kind", "doc_id", "n", "id", "block", "counts"],
            )
        give_back()

    return docs.mapInArrow(
        run, "kind int, doc_id bigint, n bigint, id bigint, block int, counts binary"
    )


def _add(counts: np.ndarray, sets: list[np.ndarray]) -> None:
    if sets:
        at, times = np.unique(_counter(np.concatenate(sets), SHINGLES), return_counts=True)
        counts[at] = np.minimum(counts[at] + times, 255)


def _packed(counts: np.ndarray) -> bytes:
    return pa.compress(counts.tobytes(), codec="zstd", asbytes=True)


def _unpacked(blob: bytes, kind: int) -> np.ndarray:
    counters, dtype = ((SHINGLES, np.uint8), (WORDS, np.uint32))[kind - 1]
    size = counters // BLOCKS * np.dtype(dtype).itemsize
    return np.frombuffer(pa.decompress(blob, size, codec="zstd"), dtype)


def _counts(survey: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sums of all tasks' counters of shingles and words: 256 tasks at a time, then all.

    The driver holds SHINGLES and WORDS numbers.
    """

    def total(rows: pa.Table) -> pa.Table:
        kind = rows.column("kind")[0].as_py()
        out = 0
        for blob in rows.column("counts").to_pylist():
            part = _unpacked(blob, kind)
            out = np.minimum(part.astype(np.uint64) + out, np.iinfo(part.dtype).max)
        packed = _packed(out.astype(part.dtype))
        return rows.select(["kind", "block"]).slice(0, 1).append_column("counts", pa.array([packed], pa.binary()))

    shape = "kind int, block int, counts binary"
    blocks = survey.filter("kind > 0").select("doc_id", "kind", "block", "counts")
    once = blocks.groupBy("doc_id", "kind", "block").applyInArrow(total, shape)
    counts = np.zeros((BLOCKS, SHINGLES // BLOCKS), np.uint8), np.zeros((BLOCKS, WORDS // BLOCKS), np.uint32)
    for r in once.groupBy("kind", "block").applyInArrow(total, shape).collect():
        counts[r.kind - 1][r.block] = _unpacked(bytes(r.counts), r.kind)
    return counts[0].reshape(-1), counts[1].reshape(-1)


def _ranks(found: np.ndarray, chance: np.ndarray) -> np.ndarray:
    """The order of elements: first those that few documents share, among them those of rare
    words, which unrelated documents do not share by chance.
    """
    return (found.astype(np.int64) << 32) + chance


def _postings(docs: DataFrame, how: Similarity, counters, light: int) -> DataFrame:
    """key, salt, id: the subsets of light sets and the prefix elements of heavy ones.

    The salt is 0 for lists that are not dealt out.

    Elements are ordered by ``_ranks``, then by hash, so that prefixes hold the rare ones.
    Copies within a task give their rows once.
    """

    def run(batches):
        begin(__name__)
        counts, words = counters.value
        logs = (16 * np.log2(words + 1.0)).astype(np.int64)

        def each(hashes: np.ndarray) -> np.ndarray:
            return logs[_counter(hashes, WORDS)]

        seen: set[int] = set()
        reach = how.least_overlap(light + 1)
        for batch in batches:
            keys, ids, salts = [], [], []
            for own, chance in _sets(batch, how.words, each):
                s = len(own)
                if not s:
                    continue
                me = set_id(own)
                if me in seen:
                    continue
                seen.add(me)
                found = counts[_counter(own, SHINGLES)]
                rank = _ranks(found, chance)
                made = 0
                most = how.prefix(s, SUBSET)
                if most < s // 2:  # the rest need not be ordered
                    rare = np.argpartition(rank, most)[:most]
                    rare = np.nonzero(rank <= rank[rare].max())[0]
                else:
                    rare = np.arange(s)
                rare = rare[np.lexsort((own[rare], rank[rare]))][:most]
                if s >= reach:
                    top = rare[: how.prefix(s, 1)]
                    keys.append(own[top])
                    made += len(top)
                    salts.append(found[top] > HOT)
                if s <= light and how.least_overlap(s) >= SUBSET:
                    pairs = np.array(list(combinations(rare.tolist(), SUBSET)))
                    key = np.full(len(pairs), 1, np.uint64)
                    for column in pairs.T:
                        key = mix(key * np.uint64(31) + own[column])
                    keys.append(key)
                    made += len(key)
                    salts.append(found[pairs].min(axis=1) > HOT)
                ids.append(np.full(made, me, np.int64))
            if not keys:
                continue
            me = np.concatenate(ids)
            dealt = 1 + (mix(me.astype(np.uint64)) % np.uint64(SALTS)).astype(np.int32)
            salt = np.where(np.concatenate(salts), dealt, 0)
            yield pa.record_batch(
                [
                    pa.array(np.concatenate(keys).astype(np.int64)),
                    pa.array(salt.astype(np.int32)),
                    pa.array(me),
                ],
                ["key", "salt", "id"],
            )
        give_back()

    return docs.mapInArrow(run, "key bigint, salt int, id bigint")


def _sized(lists: DataFrame, sizes: DataFrame, how: Similarity) -> DataFrame:
    """The lists, each cut into sets of sizes that allow a link; key and id of what is left.

    Sizes are cut into steps of the greatest ratio of linked sets; a set stands in its own
    step and the next, so any two sets that can link share one.
    """
    ratio = math.log(100 / how.percent) * (1 + 1e-9)
    step = F.floor(F.log(F.col("n").cast("double")) / ratio)
    own = lists.join(sizes, "id").withColumn("step", F.explode(F.array(step, step + 1)))
    own = own.select(F.xxhash64("key", "step").alias("key"), "id")
    several = own.groupBy("key").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).filter("lo <> hi")
    return stored(own.join(several.select("key"), "key"), "sized")


def _meetings(lists: DataFrame, sizes: DataFrame) -> DataFrame:
    """id, hub, part, left, right: the units of work in which a set is compared.

    All sets of a list meet at its hub, the set that is first in one random order for all
    lists: near copies mostly have the same hub, so most sets have few. A hub with more sets
    than a block has one unit for every two parts of them. No link is lost, and rows are sets
    and units, never pairs of sets.
    """
    first = F.min(F.struct(F.xxhash64("id").alias("turn"), "id"))["id"]
    hubs = lists.groupBy("key").agg(first.alias("hub"))
    held = stored(lists.join(hubs, "key").select("id", "hub").distinct().join(sizes, "id"), "held")
    needed = F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_ELEMENTS)
    parts = held.groupBy("hub").agg(F.ceil(needed).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("id", F.lit(1)), F.col("parts")).cast("int")
    met = held.join(parts, "hub").withColumn("part", part)
    met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    return met.select(
        "id", "hub", "part", F.least("part", "other").alias("left"), F.greatest("part", "other").alias("right")
    )


def _compared(rows: DataFrame, named: DataFrame, lists: DataFrame, how: Similarity) -> DataFrame:
    """The links (u, v) as a forest of each unit of work."""
    sizes = named.select("id", "n").distinct()
    one = named.groupBy("id").agg(F.min("doc_id").alias("_doc_id"))
    meets = stored(_meetings(_sized(lists, sizes, how), sizes).join(one, "id"), "meets")
    n = meets.count()
    bundle = F.pmod(F.xxhash64("hub", "left", "right"), F.lit(max(1, n // BUNDLE_SETS)))
    texts = rows.join(
        F.broadcast(meets) if n <= BROADCAST_IDS else meets, F.col("doc_id") == F.col("_doc_id")
    ).select("id", "hub", "part", "left", "right", "text", bundle.alias("bundle"))

    def run(bundle_rows: pa.Table) -> pa.Table:
        by = bundle_rows.sort_by([(c, "ascending") for c in ("hub", "left", "right", "id")]).combine_chunks()
        ends = np.stack([by.column(c).to_numpy() for c in ("hub", "left", "right")], axis=1)
        cuts = np.r_[0, np.nonzero((ends[1:] != ends[:-1]).any(1))[0] + 1, len(ends)]
        u, v = [], []
        for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            ids, low = _links_of(by.slice(lo, hi - lo), how)
            moved = np.nonzero(low != np.arange(len(ids)))[0]
            u.append(ids[moved])
            v.append(ids[low[moved]])
        return pa.table({"u": pa.array(np.concatenate(u), pa.int64()), "v": pa.array(np.concatenate(v), pa.int64())})

    return texts.groupBy("bundle").applyInArrow(run, "u bigint, v bigint")


def _links_of(rows: pa.Table, how: Similarity) -> tuple[np.ndarray, np.ndarray]:
    """The sets of one unit, and the first set of each set's component by links between them.

    The inverted lists of its blocks are scanned in chunks: a chunk is a matrix of sets and
    elements, and its product with itself counts what every two sets share.
    """
    ids = rows.column("id").to_numpy()
    block = rows.column("part").to_numpy()
    within = rows.column("left")[0] == rows.column("right")[0]
    sets = []
    for batch in rows.select(["text"]).to_batches():
        for piece in slices(batch, "text", SLICE):
            sets += shingle_sets(piece.column("text"), how.words)
    # an id of documents that repeats may stand for other texts, and for copies
    mine = [k for k, (s, i) in enumerate(zip(sets, ids.tolist())) if len(s) and set_id(s) == i]
    mine = [k for k, before in zip(mine, [-1, *mine]) if before < 0 or ids[k] != ids[before]]
    sets, ids, block = [sets[k] for k in mine], ids[mine], block[mine]
    sizes = np.array([len(s) for s in sets], np.int64)
    own = np.repeat(np.arange(len(sets)), sizes)
    every = np.concatenate([*sets, np.zeros(0, np.uint64)])
    order = np.argsort(every, kind="stable")
    every, own = every[order], own[order]
    fresh = np.r_[True, every[1:] != every[:-1]][: len(every)]
    column = np.cumsum(fresh) - 1
    shared = np.bincount(column) > 1 if len(column) else np.zeros(0, bool)
    number = np.cumsum(shared) - 1
    held = shared[column]
    column, own = number[column[held]], own[held]
    first = block == rows.column("left")[0].as_py()
    a = np.nonzero(first)[0]
    b = a if within else np.nonzero(~first)[0]
    both = np.zeros((len(a), len(b)), np.float32)
    starts = np.searchsorted(column, np.arange(0, int(shared.sum()) + CHUNK, CHUNK))
    for k, (lo, hi) in enumerate(zip(starts[:-1], starts[1:])):
        chunk = np.zeros((len(sets), CHUNK), np.float32)
        chunk[own[lo:hi], column[lo:hi] - k * CHUNK] = 1
        both += chunk[a] @ chunk[b].T
    found = [np.nonzero(how.near(row, sizes[k], sizes[b]))[0] for k, row in zip(a.tolist(), both)]
    i = np.repeat(a, [len(f) for f in found])
    j = b[np.concatenate([*found, np.zeros(0, np.int64)]).astype(np.int64)]
    return ids, stars(len(ids), i, j)


def ngram_join(
    docs: DataFrame,
    how: Similarity = Similarity(),
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id.

    A document's set are its distinct shingles; two documents link by ``how``; the component
    is the smallest id that links reach. All links count: the join is exact up to 64-bit
    hashes of shingles and sets.

    1. Documents with equal sets are one set with one id. Sketches count in how many documents
       each shingle and how often each word stands; their size is fixed, so they are broadcast.
    2. With elements in order of rarity, linked sets share their first common elements
       within short prefixes. Light sets write all subsets of two of their prefix, heavy
       sets their prefix as entries of inverted lists; ``boundary`` chooses what is light.
    3. Lists are cut by size, as sets that link are of like size. All sets of a list meet at its
       hub; a hub's sets, or every two blocks of them if they are many, are one unit of work,
       which gets their whole texts.
    4. A unit scans the inverted lists of all elements of its sets, which gives the size of
       every intersection, and passes on a forest of the links: pairs of sets never become
       rows, and no list is too long.

    NULL and empty texts, and texts without words, have no shingles and link with nothing.
    NULL ids stay NULL, link with nothing and have no component. Repeated rows are members of
    one component. No documents give no rows. Other columns are not read.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    survey = stored(_survey(rows, how), "survey")
    members = survey.filter("kind = 0").select("doc_id", "n", "id")
    named = members.filter("doc_id is not null and n > 0")
    # written, as the components' first step is Python too: a task with two steps takes two workers,
    # and workers that stay each fill a cache of their own in later stages
    links = stored(_links(rows.filter("doc_id is not null"), survey, named, how), "links")
    groups = components(links)
    least = named.groupBy("id").agg(F.min("doc_id").alias("low"))
    placed = least.join(groups, F.col("id") == F.col("node"), "left").select(
        "id", "low", F.coalesce("component", "id").alias("root")
    )
    placed = stored(placed, "placed")
    found = placed.join(
        placed.groupBy("root").agg(F.min("low").alias("component_id")), "root"
    ).select("id", "component_id")
    out = members.withColumn("id", F.when(F.col("doc_id").isNotNull(), F.col("id"))).join(found, "id", "left")
    return out.select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        F.coalesce("component_id", "doc_id").alias("component_id"),
    )


def _links(rows: DataFrame, survey: DataFrame, named: DataFrame, how: Similarity) -> DataFrame:
    counts, words = _counts(survey)
    sizes = named.filter("n <= 128").groupBy("n").agg(F.count("*").alias("docs")).collect()
    # prefixes hold about the rarest seventh of a set, whose lists are this long at most
    times = np.bincount(counts, minlength=256) * np.arange(256)
    scan = float(np.searchsorted(np.cumsum(times), 0.15 * times.sum()))
    light = boundary({int(r.n): int(r.docs) for r in sizes}, how, scan)
    shared = rows.sparkSession.sparkContext.broadcast((counts, words))
    order = Window.partitionBy("key", "salt").orderBy("id")
    entries = _postings(rows, how, shared, light)
    # each set once in a list, and only lists with several sets
    lists = entries.withColumn("before", F.lag("id").over(order)).filter("before is null or before <> id")
    lists = lists.withColumn("after", F.lead("id").over(order)).filter(
        "before is not null or after is not null or salt > 0"
    )
    lists = stored(lists.select("key", "salt", "id"), "lists")
    return _compared(rows, named, lists, how)


def one_of_each(
    docs: DataFrame, how: Similarity = Similarity(), id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` with the smallest id of each component, all columns as they are.

    Rows with a NULL id or without words stay. Of rows that repeat an id and a text, one stays.
    """
    found = stored(ngram_join(docs, how, id_col, text_col), "components")
    copies = found.filter("component_id <> doc_id").select(F.col("doc_id").alias("_copy_of_one"))
    few = copies.count() <= BROADCAST_IDS
    copies = copies.distinct()
    kept = docs.join(
        F.broadcast(copies) if few else copies,
        docs[id_col].cast("long") == copies["_copy_of_one"],
        "left_anti",
    )
    repeated = found.filter("doc_id is not null and n_shingles > 0").groupBy("doc_id").count()
    if repeated.filter("count > 1").isEmpty():
        return kept
    plain = F.col(id_col).isNull() | ~F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^ \t-\r]")
    return kept.filter(plain).unionByName(kept.filter(~plain).dropDuplicates([id_col, text_col]))
