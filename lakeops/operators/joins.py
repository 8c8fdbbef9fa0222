"""Join helpers.

No broadcast hints: Spark broadcasts a side only below its own size limit, otherwise it
sorts and merges, and adaptive execution splits the partition of a hot key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def typed_key_join(
    left: DataFrame, right: DataFrame, keys: dict[str, str], how: str = "inner"
) -> DataFrame:
    """Equi join on keys that are text on one side and numbers on the other.

    ``keys`` maps a key to its type. Keys that already have the type are left as they are.
    """

    def typed(df: DataFrame) -> DataFrame:
        current = dict(zip(keys, (kind for _, kind in df.select(*keys).dtypes), strict=True))
        casts = {k: F.col(k).try_cast(t) for k, t in keys.items() if current[k] != t}
        return df.withColumns(casts) if casts else df

    return typed(left).join(typed(right), list(keys), how)


def enrich_left(
    facts: DataFrame, dim: DataFrame, fact_key: str, dim_key: str, columns: Sequence[str]
) -> DataFrame:
    """Left join to a dimension, without its key column."""
    wanted = dim.select(F.col(dim_key).alias("_key"), *columns)
    return facts.join(wanted, facts[fact_key] == F.col("_key"), "left").drop("_key")


def with_child_count(
    parent: DataFrame, child: DataFrame, key: str, name: str, child_key: str | None = None
) -> DataFrame:
    """Left join to the number of child rows, 0 when there is none."""
    counts = child.groupBy(F.col(child_key or key).alias(key)).agg(F.count("*").alias(name))
    return parent.join(counts, key, "left").fillna(0, subset=[name])


def lookup(
    rows: DataFrame, table: DataFrame, keys: Sequence[str], value: str, default
) -> DataFrame:
    """Left join to one value per key, with a default for a missing key."""
    found = table.select(*keys, F.col(value))
    return rows.join(found, list(keys), "left").withColumn(
        value, F.coalesce(F.col(value), F.lit(default))
    )
