"""Tables stored for joins and for skipping: bucketed by a key, or clustered along a curve."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.workspace import new_folder

#: Rows that the ranges of a clustering are cut from, and bits of each column's range.
SAMPLE_ROWS, BITS = 20_000, 6


def store_bucketed(
    df: DataFrame, keys: Sequence[str], buckets: int | None = None, sort_by: Sequence[str] = (), name: str = "bucketed"
) -> DataFrame:
    """Write ``df`` as a table of the catalog, bucketed and sorted by ``keys``, and return it.

    Tables of one number of buckets are joined and grouped by the keys, or by more columns
    with them, without an exchange, at any size. The rows of a key are one task's work, so the
    key must be a fine one. One task writes a bucket, as one file; ``buckets`` (by default
    the number of shuffle partitions) should leave some 256 MB in each. The files lie in the
    shared folder; drop the table by its name when it is no longer needed.
    """
    spark = df.sparkSession
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex}"
    dealt = df.repartition(buckets, *keys)
    writer = dealt.write.bucketBy(buckets, *keys).sortBy(*keys, *sort_by)
    writer.option("path", new_folder(spark, table)).saveAsTable(table)
    return spark.table(table)


def _bounds(df: DataFrame, columns: Sequence[str]) -> dict[str, list]:
    """Values that cut each column into about 2^BITS ranges of equal rows, from a sample.

    The sample has about SAMPLE_ROWS rows; it only shapes the files, never a result.
    """
    share = min(1.0, SAMPLE_ROWS / max(df.count(), 1))
    rows = df.select(*columns).sample(share, seed=1).limit(2 * SAMPLE_ROWS).collect()
    cuts = {}
    for c in columns:
        values = sorted(r[c] for r in rows if r[c] is not None)
        parts = 1 << BITS
        cuts[c] = sorted({values[i * len(values) // parts] for i in range(1, parts)}) if values else []
    return cuts


def _range_of(value: Column, cuts: list) -> Column:
    """How many of the cuts are not above the value, found by halving; 0 for NULL."""

    def found(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low).cast("long")
        mid = (low + high) // 2
        return F.when(value < F.lit(cuts[mid]), found(low, mid)).otherwise(found(mid + 1, high))

    return F.when(value.isNull(), F.lit(0).cast("long")).otherwise(found(0, len(cuts)))


def curve(df: DataFrame, columns: Sequence[str]) -> Column:
    """A row's place on a curve through the ranges of all columns: their bits in turn.

    Rows near each other on it are near in every column. NULL comes first.
    """
    places = [_range_of(F.col(c), cuts) for c, cuts in _bounds(df, columns).items()]
    out = F.lit(0).cast("long")
    for bit in range(BITS):
        for i, place in enumerate(places):
            one = F.shiftright(place, bit).bitwiseAND(F.lit(1).cast("long"))
            out = out.bitwiseOR(F.shiftleft(one, bit * len(places) + i))
    return out


def clustered(df: DataFrame, columns: Sequence[str], files: int | None = None) -> DataFrame:
    """``df`` dealt to partitions, and sorted in them, by the place on ``curve``.

    The place is a column until then: an expression in the order would be worked out again for
    each comparison of two rows.
    """
    place = f"_place_{uuid.uuid4().hex}"
    order = [place, *columns]
    placed = df.withColumn(place, curve(df, columns))
    dealt = placed.repartitionByRange(files, *order) if files else placed.repartitionByRange(*order)
    return dealt.sortWithinPartitions(*order).drop(place)


def write_clustered(
    df: DataFrame, path: str, columns: Sequence[str], bloom: dict[str, int] | None = None, files: int | None = None
) -> None:
    """Write ``df`` so that a filter on any of ``columns`` skips most files by their statistics.

    Rows are dealt to files by their place on ``curve``. ``bloom`` names columns, and how many
    different values a file has of them at most, that get a bloom filter: a value between a
    file's least and greatest that it does not hold is skipped too. A value with many rows
    spreads over several files.
    """
    writer = clustered(df, columns, files).write
    for column, values in (bloom or {}).items():
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
        writer = writer.option(f"parquet.bloom.filter.expected.ndv#{column}", str(values))
    writer.parquet(path)
