"""Bounded labelled samples and a small logistic fit, for the learned operators."""


from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.llm.common import begin, bounded_sample, give_back


def labelled(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_label: int, seed: int = 0
) -> DataFrame:
    """id, text, y of at most ``per_label`` documents of each label among those to learn from.

    The ids are chosen from the labels alone; their number is bounded, so they are broadcast
    to the scan of the documents. Repeated labels of an id count as its largest.
    """
    known = (
        labels.select(F.col("doc_id").alias("id"), F.col(label).alias("y"))
        .filter("id is not null and y is not null")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .filter(learn)
    )
    chosen = bounded_sample(known, "id", ["y"], per_label, seed)
    texts = docs.select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    return texts.join(F.broadcast(chosen), "id")


def without_copies(sample: DataFrame, signs: int = 4) -> DataFrame:
    """The sample (id, text, y) without texts that share one of ``signs`` smallest hashes of
    three words with a text of a smaller id: copies and most near copies.
    """

    @F.pandas_udf("array<bigint>")
    def smallest(texts: pd.Series) -> pd.Series:
        def least(text):
            words = text.encode().split()
            parts = {b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))}
            return [min(xxhash.xxh3_64_intdigest(p, seed) for p in parts) >> 1 for seed in range(signs)]

        return texts.map(least)

    signed = sample.withColumn("signs", smallest("text"))
    # outer: else Spark drops texts without signs first, by a second call of the function in the same task
    pairs = signed.select("id", F.posexplode_outer("signs").alias("n", "sign"))
    later = pairs.join(
        pairs.groupBy("n", "sign").agg(F.min("id").alias("low")), ["n", "sign"]
    ).filter("id > low")
    return sample.join(later.select("id").distinct(), "id", "left_anti")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Weights (one per column, then the constant) by Newton steps with a small ridge."""
    a = np.c_[x, np.ones(len(x))]
    w = np.zeros(a.shape[1])
    w[-1] = np.log((y.sum() + 0.5) / (len(y) - y.sum() + 0.5))
    penalty = np.full(a.shape[1], ridge * len(y) / 100 + 1e-6)
    penalty[-1] = 1e-6

    def loss(v):
        z = a @ v
        return np.logaddexp(0, np.where(y > 0, -z, z)).sum() + 0.5 * (penalty * v * v).sum()

    for _ in range(50):
        p = sigmoid(a @ w)
        gradient = a.T @ (p - y) + penalty * w
        step = np.linalg.solve((a.T * (p * (1 - p))) @ a + np.diag(penalty), gradient)
        size = 1.0
        while size > 1e-4 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-6:
            break
    return w


def sigmoid(z):
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def scored(score: Callable[[str], float]):
    """A column function that scores texts; NULL is the empty text."""

    @F.pandas_udf("double")
    def column(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        begin(score.__qualname__)
        for batch in batches:
            yield batch.fillna("").map(score).astype(float)
        give_back()

    return column
