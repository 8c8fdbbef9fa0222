"""Connected components of an edge list, without collecting it anywhere."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.workspace import stored

#: Edges that a task contracts at once.
CONTRACT_ROWS = 200_000


def stars(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For n rows linked by the pairs (i, j): the smallest row of each row's component."""
    label = np.arange(n)
    while True:
        low = label.copy()
        np.minimum.at(low, i, label[j])
        np.minimum.at(low, j, label[i])
        low = low[low]
        if (low == label).all():
            return label
        label = low


def forest(left: list, right: list) -> tuple[list, list]:
    """Star edges (node, smallest node of its component) of the given edges."""
    parent: dict = {}

    def find(x):
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    for a, b in zip(left, right):
        a, b = find(a), find(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    stars = [(x, find(x)) for x in list(parent)]
    stars = [(x, r) for x, r in stars if x != r]
    return [x for x, _ in stars], [r for _, r in stars]


def contracted(edges: DataFrame) -> DataFrame:
    """The same components with fewer edges: a forest for each batch of edges."""

    def run(batches):
        for batch in batches:
            for start in range(0, batch.num_rows, CONTRACT_ROWS):
                piece = batch.slice(start, CONTRACT_ROWS)
                u, v = forest(piece.column(0).to_pylist(), piece.column(1).to_pylist())
                yield pa.record_batch([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    return edges.select("u", "v").mapInArrow(run, "u bigint, v bigint")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of ``edges`` (u, v): the smallest node it reaches.

    Large and small stars take turns until every node hangs on the smallest node of its
    component. Each round is written to the shared folder, so lost executors repeat one
    round at most. Nodes are longs; edges with a NULL end or between a node and itself, and
    repeated edges, change nothing. No edges give no rows.
    """
    plain = edges.select(F.col("u").cast("long"), F.col("v").cast("long")).filter("u <> v")
    now = stored(contracted(plain).distinct(), "edges")
    mark = _mark(now)
    while mark[0]:
        # large star: larger neighbours of each node hang on the smallest of all neighbours
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m"))
        low = low.select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.filter("u <> v").distinct()
        # small star: each node and its smaller neighbours hang on the smallest of them
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            down.join(least, "u")
            .select(F.explode(F.array("u", "v")).alias("u"), F.col("m").alias("v"))
            .filter("u <> v")
            .distinct()
        )
        now = stored(small, "edges")
        before, mark = mark, _mark(now)
        if mark == before:
            break
    return now.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("component")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Number of edges, and a sum over their hashes."""
    hashed = F.xxhash64("u", "v").cast("decimal(20,0)")
    return tuple(edges.agg(F.count("*"), F.sum(hashed)).first())
