"""Near duplicates among vectors: cross-polytope hashing after fast Hadamard rotations."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.components import components, stars
from lakeops.workspace import stored


#: Buckets up to this size are compared pair by pair, larger ones as matrices.
FEW = 16

#: Rows of small buckets that are handled together.
GROUP_ROWS = 8192


@dataclass(frozen=True)
class Hashing:
    """Tables of ``functions`` joined cross-polytope hashes each, with ``functions`` probes.

    For a cosine of 0.98 in 64 dimensions, a pair meets in one table of two functions with
    probability 0.85, so in one of four tables with 0.9995 (measured on random pairs); the
    chance falls with the number of functions and rises with the number of tables.
    """

    tables: int = 4
    functions: int = 2
    seed: int = 7
    block: int = 1024  # rows of a bucket that one task holds against as many others

    @staticmethod
    def for_rows(rows: int, dim: int) -> Hashing:
        """A further function whenever buckets of unrelated vectors would pass about 100."""
        per = 2 * _padded(dim)
        functions = max(2, math.ceil(math.log(max(rows, 1) / 100, per)))
        return Hashing(tables=math.ceil(math.log(0.0005) / math.log(1 - 0.92**functions)),
                       functions=functions)


def _padded(dim: int) -> int:
    return 1 << max(0, dim - 1).bit_length()


def hadamard(x: np.ndarray) -> np.ndarray:
    """Fast Walsh-Hadamard transform of each row; the width is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, -1, 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(n, d)
        h *= 2
    return x / math.sqrt(d)


def codes(x: np.ndarray, how: Hashing) -> tuple[np.ndarray, np.ndarray]:
    """Bucket of each row in each table, and the probed buckets (one function changed each)."""
    n, dim = x.shape
    d = _padded(dim)
    x = np.pad(x, ((0, 0), (0, d - dim)))
    rng = np.random.default_rng(how.seed)
    main = np.zeros((n, how.tables), np.int64)
    probe = np.zeros((n, how.tables, how.functions), np.int64)
    for t in range(how.tables):
        first, second = [], []
        for _ in range(how.functions):
            y = x
            for _ in range(3):
                y = hadamard(y * rng.choice([-1.0, 1.0], size=d))
            order = np.argsort(-np.abs(y), axis=1, kind="stable")[:, : min(2, d)]
            vertex = 2 * order + (np.take_along_axis(y, order, 1) < 0)
            first.append(vertex[:, 0])
            second.append(vertex[:, -1])
        for f in range(how.functions):
            main[:, t] = main[:, t] * (2 * d) + first[f]
            for p in range(how.functions):
                probe[:, t, p] = probe[:, t, p] * (2 * d) + (second[f] if f == p else first[f])
    return main, probe


def usable(vector: Column) -> Column:
    """The vector has components, all finite, and is not zero."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0)


def _units(arrays: pa.Array, dim: int) -> np.ndarray:
    x = arrays.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no overflow in the squares
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _hashed(classes: DataFrame, how: Hashing) -> DataFrame:
    """A row for each class, table and bucket it is in (role 0) or probes (role 1)."""

    def run(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims):
                part = batch.filter(pa.array(dims == dim))
                main, probe = codes(_units(part.column("vector"), int(dim)), how)
                n, t, k = len(main), how.tables, how.functions
                every = np.concatenate([main[:, :, None], probe], axis=2)
                take = pa.array(np.repeat(np.arange(n), t * (1 + k)))
                own = pa.array(list(every.reshape(n, -1)), pa.list_(pa.int64()))
                yield pa.record_batch(
                    [
                        part.column("label").take(take),
                        part.column("dim").take(take),
                        pa.array(np.tile(np.repeat(np.arange(t), 1 + k), n), pa.int32()),
                        pa.array(every.reshape(-1)),
                        pa.array(np.tile(np.r_[0, np.ones(k, int)], n * t), pa.int32()),
                        part.column("id").take(take),
                        part.column("copies").take(take),
                        part.column("vector").take(take),
                        own.take(take),
                    ],
                    ["label", "dim", "t", "code", "role", "id", "copies", "vector", "codes"],
                )

    return classes.mapInArrow(
        run,
        "label string, dim int, t int, code bigint, role int, id bigint, copies bigint,"
        " vector array<double>, codes array<bigint>",
    )


def _links(rows: pa.Table, threshold: float, how: Hashing) -> pa.Table:
    """Links within each bucket of ``rows``, or between two blocks of a large bucket.

    A pair may meet in several buckets. It counts in the first table where it meets: in the
    common bucket, or else where the one probes the other's bucket (the smaller id's probe,
    if both do). Results: the copies linked to each class (kind 0), and a forest of the links
    (kind 1).
    """
    names = ["label", "dim", "t", "code", "left", "right"]
    rows = rows.sort_by([(c, "ascending") for c in names]).combine_chunks()
    ids, copies = rows.column("id").to_numpy(), rows.column("copies").to_numpy()
    probes, part = rows.column("role").to_numpy() == 1, rows.column("part").to_numpy()
    t, dims = rows.column("t").to_numpy(), rows.column("dim").to_numpy()
    split = rows.column("left").to_numpy() != rows.column("right").to_numpy()
    own = rows.column("codes").combine_chunks().flatten().to_numpy()
    own = own.reshape(len(ids), how.tables, 1 + how.functions)
    fresh = np.zeros(len(ids), bool)
    fresh[0] = True
    for c in names:
        codes_ = rows.column(c).combine_chunks().dictionary_encode().indices.to_numpy()
        fresh[1:] |= codes_[1:] != codes_[:-1]
    group = np.cumsum(fresh)
    starts = np.r_[np.nonzero(fresh)[0], len(ids)]
    sizes = np.diff(starts)
    found_i, found_j = [], []

    def accept(i: np.ndarray, j: np.ndarray) -> None:
        """Keep the pairs that count here; i and j stand in one bucket and are near."""
        ok = ~(probes[i] & probes[j]) & (ids[i] != ids[j]) & (~split[i] | (part[i] != part[j]))
        i, j = i[ok], j[ok]
        i, j = np.where(probes[i], j, i), np.where(probes[i], i, j)  # i is a member
        a, b = own[i], own[j]
        same = a[:, :, 0] == b[:, :, 0]
        to_j = (a[:, :, 1:] == b[:, :, :1]).any(2)
        to_i = (b[:, :, 1:] == a[:, :, :1]).any(2)
        first = np.argmax(same | to_j | to_i, axis=1) == t[i]
        here = np.arange(len(i)), t[i]
        keep = first & (~probes[j] | ~to_j[here] | (ids[j] < ids[i]))
        found_i.append(i[keep])
        found_j.append(j[keep])

    for dim in np.unique(dims):
        at = np.nonzero(dims == dim)[0]
        x = np.zeros((len(ids), int(dim)))
        x[at] = _units(rows.column("vector").combine_chunks().take(pa.array(at)), int(dim))
        few = np.repeat((sizes <= FEW), sizes) & (dims == dim)
        for off in range(1, FEW):
            i = np.nonzero(few[:-off] & (group[off:] == group[:-off]))[0]
            for s in range(0, len(i), 1 << 16):
                p = i[s : s + (1 << 16)]
                near = np.einsum("ij,ij->i", x[p], x[p + off]) >= threshold
                accept(p[near], p[near] + off)
        for g in np.nonzero((sizes > FEW) & (dims[starts[:-1]] == dim))[0]:
            lo, hi = starts[g], starts[g + 1]
            for s in range(lo, hi, how.block):
                for e in range(s, hi, how.block):
                    p, q = slice(s, min(s + how.block, hi)), slice(e, min(e + how.block, hi))
                    i, j = np.nonzero(x[p] @ x[q].T >= threshold)
                    once = i + s < j + e
                    accept(i[once] + s, j[once] + e)
    i, j = np.concatenate([*found_i, []]).astype(int), np.concatenate([*found_j, []]).astype(int)
    # the same class may stand in many rows
    nodes, at = np.unique(ids, return_inverse=True)
    i, j = at[i], at[j]
    weight = np.zeros(len(nodes), np.int64)
    weight[at] = copies
    counts = np.bincount(i, weight[j], len(nodes)) + np.bincount(j, weight[i], len(nodes))
    label = stars(len(nodes), i, j)
    some, moved = np.nonzero(counts)[0], np.nonzero(label != np.arange(len(nodes)))[0]
    return pa.table(
        {
            "u": pa.array(np.r_[nodes[some], nodes[moved]], pa.int64()),
            "v": pa.array(np.r_[counts[some].astype(np.int64), nodes[label[moved]]], pa.int64()),
            "kind": pa.array(np.r_[np.zeros(len(some), int), np.ones(len(moved), int)], pa.int32()),
        }
    )


def near_duplicates(
    vectors: DataFrame,
    threshold: float = 0.98,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    how: Hashing | None = None,
) -> DataFrame:
    """One row per input row: id, n_links, component_id, kept.

    Rows link if their labels are equal and not NULL and their cosine, in double precision,
    is at least ``threshold``; the pair must meet in a bucket (see ``Hashing``). Equal vectors
    of a label are one class, so copies are counted and never held against each other. A
    bucket of more than a block is cut, and every pair of blocks is a group of its own: a large
    bucket is spread over many tasks, and no group holds more than two blocks. Pairs of vectors never become rows:
    a group returns counts and a forest of its links.

    NULL vectors, vectors with NULL or non-finite components and zero vectors, rows with a
    NULL id or label: no links, their own component. Repeated rows count as linked copies.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        vectors[label_col].cast("string").alias("label"),
        vectors[vector_col].cast("array<double>").alias("vector"),
    )
    ok = usable(F.col("vector")) & F.col("id").isNotNull() & F.col("label").isNotNull()
    good = rows.filter(ok).withColumn("dim", F.size("vector"))
    same = F.sha2(F.array_join(F.transform("vector", lambda x: (x + 0.0).cast("string")), " "), 256)
    keyed = good.withColumn("same", same)
    classes = stored(
        keyed.groupBy("label", "same").agg(
            F.min("id").alias("id"),
            F.count("*").alias("copies"),
            F.first("vector").alias("vector"),
            F.first("dim").alias("dim"),
        ),
        "classes",
    )
    if how is None:
        n, dim = classes.agg(F.count("*"), F.max("dim")).first()
        how = Hashing.for_rows(n or 0, dim or 1)
    # one id may stand for several vectors (repeated ids): classes get numbers of their own
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "numbered")
    hashed = stored(_hashed(classes.drop("id").withColumnRenamed("node", "id"), how), "hashed")
    bucket = ["label", "dim", "t", "code"]
    sizes = hashed.groupBy(*bucket).agg(
        F.count("*").alias("n"), F.count(F.when(F.col("role") == 0, 1)).alias("members")
    )
    sizes = sizes.filter("n > 1 and members > 0").select(
        *bucket, F.ceil(F.col("n") / how.block).cast("int").alias("parts")
    )
    groups = max(1, hashed.count() // GROUP_ROWS)
    alone = F.xxhash64(*bucket, "left", "right")
    placed = (
        hashed.join(sizes, bucket)
        .withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .withColumn("left", F.least("part", "other"))
        .withColumn("right", F.greatest("part", "other"))
        .withColumn("group", F.when(F.col("parts") == 1, F.pmod(alone, F.lit(groups))).otherwise(alone))
        .drop("parts", "other")
    )

    def run(rows: pa.Table) -> pa.Table:
        return _links(rows, threshold, how)

    out = stored(placed.groupBy("group").applyInArrow(run, "u bigint, v bigint, kind int"), "links")
    counts = out.filter("kind = 0").groupBy(F.col("u").alias("node")).agg(F.sum("v").alias("found"))
    joined = components(out.filter("kind = 1"))
    facts = stored(
        classes.select("label", "same", "id", "copies", "node")
        .join(counts, "node", "left")
        .join(joined, "node", "left")
        .select(
            "label",
            "same",
            "id",
            (F.col("copies") - 1 + F.coalesce("found", F.lit(0))).alias("links"),
            F.coalesce("component", "node").alias("component"),
        ),
        "facts",
    )
    lowest = facts.groupBy("component").agg(F.min("id").alias("component_id"))
    facts = facts.join(lowest, "component").select("label", "same", "links", "component_id")
    return (
        rows.withColumn("same", F.when(ok, same))
        .join(facts, ["label", "same"], "left")
        .select(
            "id",
            F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
            F.coalesce("component_id", "id").alias("component_id"),
        )
        .withColumn("kept", F.coalesce(F.col("id") == F.col("component_id"), F.lit(False)))
    )
