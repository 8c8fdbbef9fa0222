"""Exact top-k by inner product: sorted lists read in step, with lower and upper bounds."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Queries that a task holds; more are cut into blocks, each of which meets every vector.
QUERY_BLOCK = 16_384
#: Vectors whose lists are sorted together, and queries that are bounded at once.
VECTOR_BLOCK, QUERY_STEP = 4096, 512
#: Rows per query that are scored without reading the lists further.
RESOLVE = 32


def finite(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~bad


class Search:
    """The best ``k`` rows of each query among the vectors that were offered so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        order = np.argsort(ids, kind="stable")
        self.ids, self.q, self.k = ids[order], vectors[order], k
        self.score = np.zeros(0, np.int64)
        self.query = np.zeros(0, np.int64)
        self.row = np.zeros(0, np.int64)

    def _floor(self) -> np.ndarray:
        """The k-th best score of each query so far."""
        out = np.full(len(self.ids), -np.inf)
        last = np.r_[self.query[1:] != self.query[:-1], True] if len(self.query) else []
        rank = _ranks(self.query)
        full = np.nonzero(np.asarray(last, bool) & (rank == self.k - 1))[0]
        out[self.query[full]] = self.score[full]
        return out

    def offer(self, ids: np.ndarray, x: np.ndarray) -> None:
        for s in range(0, len(ids), VECTOR_BLOCK):
            self._block(ids[s : s + VECTOR_BLOCK], x[s : s + VECTOR_BLOCK])

    def _block(self, ids: np.ndarray, x: np.ndarray) -> None:
        n, d = x.shape
        down = np.argsort(-x, axis=0, kind="stable")
        rank = np.empty_like(down)
        np.put_along_axis(rank, down, np.arange(n)[:, None], axis=0)
        lists = np.take_along_axis(x, down, axis=0).astype(float)
        floor = self._floor()
        largest = float(np.abs(x).max(initial=0)) * float(np.abs(self.q).max(initial=0)) * max(d, 1)
        exact = largest < 2**52  # the bounds are sums of doubles
        kept_q, kept_r = [], []
        for s in range(0, len(self.ids), QUERY_STEP):
            active = np.arange(s, min(s + QUERY_STEP, len(self.ids)))
            depth = n if not exact else max(1, n // 4)
            while len(active):
                lower, upper = self._bounds(active, x, lists, rank, depth, exact)
                own = self.ids[active][:, None] == ids[None, :]
                lower[own] = upper[own] = -np.inf
                if n > self.k:
                    kth = np.partition(lower, n - self.k, axis=1)[:, n - self.k]
                else:
                    kth = np.full(len(active), -np.inf)
                # a row outside the best k can still qualify if its upper bound reaches the k-th
                open_ = (upper >= np.maximum(kth, floor[active])[:, None]) & ~own
                done = (open_.sum(axis=1) <= RESOLVE) | (depth >= n)
                i, r = np.nonzero(open_ & done[:, None])
                kept_q.append(active[i])
                kept_r.append(r)
                active = active[~done]
                depth = min(n, depth * 2)
        i, r = np.concatenate([*kept_q, []]).astype(int), np.concatenate([*kept_r, []]).astype(int)
        score = np.empty(len(i), np.int64)
        for s in range(0, len(i), 1 << 16):
            e = s + (1 << 16)
            score[s:e] = np.einsum("ij,ij->i", self.q[i[s:e]], x[r[s:e]])
        self._keep(i, score, ids[r])

    def _bounds(self, active, x, lists, rank, depth, exact):
        """Bounds of each score after ``depth`` entries of each list.

        A list is read from its top where the query's component is positive and from its
        bottom where it is negative. A component that was not read lies between the last
        entry read and the list's other end.
        """
        n = len(x)
        if not exact:
            return np.full((len(active), n), -np.inf), np.full((len(active), n), np.inf)
        q = self.q[active].astype(float)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        top, bottom = rank < depth, rank >= n - depth
        upper = up @ np.where(top, x, lists[depth - 1]).T
        upper += down @ np.where(bottom, x, lists[n - depth]).T
        if depth >= n:
            return upper.copy(), upper
        lower = up @ np.where(top, x, lists[n - 1]).T
        lower += down @ np.where(bottom, x, lists[0]).T
        return lower, upper

    def _keep(self, query, score, row) -> None:
        query = np.r_[self.query, query]
        score, row = np.r_[self.score, score], np.r_[self.row, row]
        order = np.lexsort((row, -score, query))
        query, score, row = query[order], score[order], row[order]
        best = _ranks(query) < self.k
        self.query, self.score, self.row = query[best], score[best], row[best]

    def best(self) -> pa.RecordBatch:
        return pa.record_batch(
            [pa.array(self.ids[self.query], pa.int64()), pa.array(self.row, pa.int64()), pa.array(self.score, pa.int64())],
            ["query_id", "vec_id", "score"],
        )


def _ranks(groups: np.ndarray) -> np.ndarray:
    """Position of each entry within its run of equal values."""
    if not len(groups):
        return np.zeros(0, int)
    start = np.r_[True, groups[1:] != groups[:-1]]
    at = np.arange(len(groups))
    return at - np.maximum.accumulate(np.where(start, at, 0))


def _search(k: int):
    """Partitions sorted by group, queries before vectors; vectors stream past the queries."""

    def run(batches):
        key, held, search = None, [], None

        def finish():
            if search is not None:
                yield search.best()

        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("dim", "block", "part", "kind")], 1)
            cuts = np.r_[0, np.nonzero((keys[1:] != keys[:-1]).any(1))[0] + 1, len(keys)]
            for lo, hi in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                if lo == hi:
                    continue
                group, kind = tuple(keys[lo, :3].tolist()), int(keys[lo, 3])
                if group != key:
                    yield from finish()
                    key, held, search = group, [], None
                piece = batch.slice(lo, hi - lo)
                ids = piece.column("id").to_numpy()
                x = piece.column("vector").flatten().to_numpy().reshape(len(ids), group[0])
                if kind == 0:
                    held.append((ids, x))
                elif held or search is not None:
                    if search is None:
                        search = Search(*(np.concatenate(a) for a in zip(*held)), k)
                    search.offer(ids, x)
        yield from finish()

    return run


def top_k(
    vectors: DataFrame,
    query: Column,
    k: int = 5,
    scale: float = 256.0,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` best rows by integer inner product.

    ``query`` marks the query rows. Components become floor(scale * x); every row but those
    of the query's own id is a candidate, if it has as many components. Ties go to the
    smaller id. Vectors that are NULL or hold NULL or non-finite components, and rows with a
    NULL id, take no part. Repeated query rows count once, repeated candidates each. Scores
    are 64-bit sums.

    Queries are cut into blocks and vectors into parts, and each block meets each part in one
    group. A group holds its queries and streams its vectors, in blocks whose components are
    sorted lists: the lists are read to a depth, each score is bounded from what was read,
    and rows whose upper bound is below the k-th lower bound are out. Reading ends when few
    rows are left, and their scores are then resolved. Groups pass on k rows per query.
    """
    rows = vectors.select(
        vectors[id_col].cast("long").alias("id"),
        vectors[vector_col].cast("array<double>").alias("vector"),
        F.coalesce(query, F.lit(False)).alias("asks"),
    )
    rows = rows.filter(finite(F.col("vector")) & F.col("id").isNotNull()).select(
        "id",
        F.transform("vector", lambda x: F.floor(x * F.lit(scale)).cast("long")).alias("vector"),
        F.size("vector").cast("long").alias("dim"),
        "asks",
    )
    n, asking = rows.agg(F.count("*"), F.count(F.when(F.col("asks"), 1))).first()
    blocks = max(1, -(-asking // QUERY_BLOCK))
    parts = max(1, min(-(-n // VECTOR_BLOCK), max(64, -(-n // 4_000_000))))
    spread = F.xxhash64("id", "vector")
    asked = rows.filter("asks").dropDuplicates(["id", "vector"])
    asked = asked.select(
        "dim",
        F.pmod(spread, F.lit(blocks)).alias("block"),
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))).alias("part"),
        F.lit(0).cast("long").alias("kind"),
        "id",
        "vector",
    )
    offered = rows.select(
        "dim",
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))).alias("block"),
        F.pmod(spread, F.lit(parts)).alias("part"),
        F.lit(1).cast("long").alias("kind"),
        "id",
        "vector",
    )
    met = (
        asked.unionByName(offered)
        .repartition("dim", "block", "part")
        .sortWithinPartitions("dim", "block", "part", "kind")
        .mapInArrow(_search(k), "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
