"""Upsert and update of tables that have no row-level MERGE."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.operators.quality import assert_unique
from lakeops.sources.files import write_table
from lakeops.workspace import stored


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _names(newer_by: str | Sequence[str] | None) -> list[str]:
    return [newer_by] if isinstance(newer_by, str) else list(newer_by or ())


def _struct(columns: Sequence[Column]) -> Column:
    """Columns that are compared in turn; NULL sorts first."""
    return F.struct(*[c.alias(f"c{i}") for i, c in enumerate(columns)])


def upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    insert: bool = True,
    newer_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """State of ``target`` after merging ``source``, one source row per key.

    A matched row takes every source value, NULL included; an unmatched source row is
    inserted. NULL keys match nothing. Target columns the source lacks stay as they are.
    With ``newer_by`` (columns, compared in turn, NULL first) an older source row does not
    replace a newer target row.

    The target is the streamed side of each join: it is not shuffled when the source is
    small enough to broadcast, and a key that many target rows share can be split. The
    source is read three times; store it first (see ``workspace.stored``) if it is costly.
    """
    given = set(source.columns)
    new = source.select(*[F.col(c).alias(f"_s_{c}") for c in source.columns]).withColumn(
        "_in_source", F.lit(True)
    )
    joined = target.join(new, _all([F.col(k) == F.col(f"_s_{k}") for k in keys]), "left")
    take = F.col("_in_source").isNotNull()
    if newer_by:
        order = _names(newer_by)
        older = _struct([F.col(f"_s_{c}") for c in order]) < _struct([F.col(c) for c in order])
        take = take & ~older
    updated = joined.select(
        *[
            (F.when(take, F.col(f"_s_{c}")).otherwise(F.col(c)) if c in given else F.col(c)).alias(c)
            for c in target.columns
        ]
    )
    if not insert:
        return updated
    source_keys = source.select(*keys)
    matched = target.select(*keys).join(source_keys, list(keys), "left_semi").distinct()
    added = source.join(matched, list(keys), "left_anti")
    return updated.unionByName(
        added.select(*[c for c in target.columns if c in given]), allowMissingColumns=True
    )


def replace_rows(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    newer_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """``upsert`` for a source with every column: matched target rows give way to the source.

    One join that streams the target. A key that the target holds twice is one row after it,
    so repeating a merge that stopped half-way repairs the table.
    """
    order = _names(newer_by)
    names = list(dict.fromkeys([*keys, *order]))
    kept, new = target, source.select(*target.columns)

    def same_key(left: DataFrame, right: DataFrame) -> Column:
        return _all([left[k] == right[f"_o_{k}"] for k in keys])

    def others(df: DataFrame) -> DataFrame:
        return df.select(*[F.col(c).alias(f"_o_{c}") for c in names])

    from_source, from_target = others(source), others(target)
    beaten = same_key(target, from_source)
    if newer_by:
        late = _struct([from_source[f"_o_{c}"] for c in order]) < _struct([target[c] for c in order])
        beaten = beaten & ~late
        new = new.join(
            from_target,
            same_key(new, from_target)
            & (_struct([new[c] for c in order]) < _struct([from_target[f"_o_{c}"] for c in order])),
            "left_anti",
        )
    return kept.join(from_source, beaten, "left_anti").unionByName(new)


def update_matched(
    target: DataFrame,
    source: DataFrame,
    on: dict[str, str],
    values: dict[str, str],
    ignore_case: bool = True,
) -> DataFrame:
    """Update-only merge: ``values`` maps target to source columns, ``on`` the text keys.

    Source keys must be unique (see ``first_per_key``).
    """

    def key(col: Column) -> Column:
        return F.lower(col) if ignore_case else col

    new = source.select(
        *[key(F.col(s)).alias(f"_k_{t}") for t, s in on.items()],
        *[F.col(s).alias(f"_v_{t}") for t, s in values.items()],
        F.lit(True).alias("_in_source"),
    )
    joined = target.join(new, _all([key(F.col(t)) == F.col(f"_k_{t}") for t in on]), "left")
    matched = F.col("_in_source").isNotNull()
    return joined.select(
        *[
            (F.when(matched, F.col(f"_v_{c}")).otherwise(F.col(c)) if c in values else F.col(c)).alias(c)
            for c in target.columns
        ]
    )


def upsert_table(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source: DataFrame,
    keys: Sequence[str],
    partition: str,
    *,
    newer_by: str | Sequence[str] | None = None,
    sort_by: Sequence[str | Column] = (),
    check_unique: bool = True,
    fixed_partition: bool = False,
) -> list:
    """Merge ``source`` into the Parquet table at ``path``, partitioned by ``partition``.

    Only partitions that hold a matched key or get a new row are read and rewritten. The
    merged rows are staged first, so the table is never read and overwritten in one plan,
    and a failed run can be repeated. Returns the values of the rewritten partitions.

    To find the partitions of matched keys, the keys of the whole target are read. That is
    not needed with ``fixed_partition``: the partition follows from the key, so a row never
    moves. Only rows between the least and the greatest key of the source can match, so that
    range is a filter on the target. Files are sorted by ``sort_by``.
    """
    columns = [f.name for f in schema.fields]
    rows = stored(source.select(*columns), "merge-source")
    if check_unique:
        assert_unique(rows, keys)

    target = spark.read.schema(schema).parquet(path).select(*columns)
    places = rows.select(partition)
    if not fixed_partition:
        held = target.where(_key_range(rows, keys))
        held = held.join(rows.select(*keys), list(keys), "left_semi").select(partition)
        places = places.unionByName(held)
    # a row per partition directory; Spark reads those partitions of the target alone
    touched = stored(places.groupBy(partition).agg(F.count("*").alias("_rows")), "merge-places")
    held_rows = _in_partitions(target, touched, partition)

    result = stored(replace_rows(held_rows, rows, keys, newer_by), "merge-result")

    # Dynamic overwrite leaves a partition alone when all of its rows moved away. Those rows
    # are in the source, so emptying the partition first loses nothing that a repeat of the
    # merge would not bring back. The folders are found by their rows: Spark escapes values.
    filled = result.select(partition).distinct().withColumnRenamed(partition, "_filled")
    files = target.select(partition, F.col("_metadata.file_path").alias("_file"))
    left = (
        _in_partitions(files, touched, partition)
        .join(filled, F.col(partition).eqNullSafe(F.col("_filled")), "left_anti")
        .select(F.regexp_replace("_file", "/[^/]*$", "").alias("folder"))
        .distinct()
    )
    rest = T.StructType([f for f in schema.fields if f.name != partition])
    # one folder per partition whose rows all moved away
    for row in left.collect():
        spark.createDataFrame([], rest).write.mode("overwrite").parquet(unquote(row.folder))
    write_table(result, path, mode="overwrite", partition_by=[partition], sort_by=sort_by, dynamic=True)
    return [r[0] for r in touched.select(partition).orderBy(F.asc_nulls_first(partition)).collect()]


def _in_partitions(table: DataFrame, touched: DataFrame, partition: str) -> DataFrame:
    """Rows of the partitions that ``touched`` names, NULL too.

    The list is a table that is joined: its values prune the scan as it starts (dynamic
    partition pruning, for which Spark wants a filter on the list), however many they are.
    """
    named = touched.where("_rows > 0").select(partition)
    inside = table.join(named, partition, "left_semi").select(*table.columns)
    if touched.where(F.col(partition).isNull()).isEmpty():
        return inside
    return inside.unionByName(table.where(F.col(partition).isNull()))


def _key_range(rows: DataFrame, keys: Sequence[str]) -> Column:
    """Keys between the least and the greatest of ``rows``, column by column."""
    ends = rows.agg(*[f(k) for k in keys for f in (F.min, F.max)]).first()
    inside = [
        F.col(k).between(F.lit(ends[2 * i]), F.lit(ends[2 * i + 1]))
        for i, k in enumerate(keys)
        if ends[2 * i] is not None
    ]
    return _all(inside) if inside else F.lit(True)
