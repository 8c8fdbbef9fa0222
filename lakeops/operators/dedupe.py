"""One row per key, with a survivor that does not depend on the run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(
    df: DataFrame, keys: Sequence[str | Column], order: Sequence[str | Column]
) -> DataFrame:
    """First row of each key in ``order``.

    The rank filter is applied before the shuffle too (window group limit), so a hot key
    sends one row per map task and not the whole group.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(window)).where("_rn = 1").drop("_rn")


def latest_per_key(df: DataFrame, keys: Sequence[str | Column], newest: Sequence[str]) -> DataFrame:
    """Row with the greatest ``newest`` values of each key."""
    return first_per_key(df, keys, [F.col(c).desc() for c in newest])


def drop_duplicates_stable(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``dropDuplicates`` that keeps the smallest row, in column order."""
    rest = [c for c in df.columns if c not in set(keys)]
    return first_per_key(df, keys, rest or list(keys))


def with_cast_keys(df: DataFrame, types: dict[str, str], drop_null: bool = True) -> DataFrame:
    """Cast key columns leniently before a dedupe, so "012" and "12" are one key.

    Rows whose key cannot be read would be inserted again by every merge; they are
    dropped unless ``drop_null`` is False.
    """
    cast = df.withColumns({c: F.col(c).cast("string").try_cast(t) for c, t in types.items()})
    return cast.dropna(subset=list(types)) if drop_null else cast
