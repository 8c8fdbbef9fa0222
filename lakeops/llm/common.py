"""Helpers that several operators share."""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeops.workspace import stored

#: Text bytes handled at once inside a task; a longer single text is handled alone.
SLICE_BYTES = 4 << 20
#: Bytes that Spark sends to Python at once.
BATCH_BYTES = 4 << 20
#: Groups of a sample whose limits are broadcast.
SENT_GROUPS = 10_000


#: What this worker process keeps between tasks, and the kind of task it is for.
_kept: dict = {}
_kind: list[str] = [""]


def begin(kind: str) -> None:
    """Call when a task starts: what tasks of another kind kept is dropped, and memory given back.

    Workers outlive stages; without this each would hold the caches of all stages so far.
    """
    if _kind[0] == kind:
        return
    _kind[0] = kind
    _kept.clear()
    give_back()


def give_back() -> None:
    """Call when a task ends: memory that it used goes back to the machine."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries do this by themselves
        ctypes.CDLL(None).malloc_trim(0)


def kept(key: str, make: Callable):
    """``make()`` of an earlier task of the same kind in this process, or a new one."""
    if key not in _kept:
        _kept[key] = make()
    return _kept[key]


def small_batches(spark: SparkSession) -> None:
    """Let Spark send documents to Python by a few MB, unless the session says otherwise.

    A batch stands in memory on both sides; one with a longer text holds that text alone.
    """
    for key, value in {"maxBytesPerBatch": str(BATCH_BYTES), "maxRecordsPerBatch": "2000"}.items():
        name = f"spark.sql.execution.arrow.{key}"
        if spark.conf.get(name, None) is None:
            spark.conf.set(name, value)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; NULL for a NULL id."""
    return F.crc32(F.col(id_col).cast("string")) % F.lit(parts)


def slices(
    batch: pa.RecordBatch, column: str, most: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Pieces of a batch with about ``most`` bytes of ``column`` each, one row at least."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start = held = 0
    for i, size in enumerate(sizes):
        if i > start and held + size > most:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += size
    if len(sizes) > start:
        yield batch.slice(start)


def map_slices(
    df: DataFrame,
    column: str,
    make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]],
    schema: str,
) -> DataFrame:
    """Apply ``make()(piece)`` to pieces of bounded size; ``make`` runs once in each task."""
    kind = make.__module__

    def run(batches):
        begin(kind)
        work = make()
        for batch in batches:
            for piece in slices(batch, column):
                yield work(piece)
        give_back()

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, column: str) -> list[str]:
    """The texts of a batch; NULL is the empty text."""
    return [t or "" for t in batch.column(column).to_pylist()]


def bounded_sample(
    df: DataFrame, id_col: str, groups: list[str], per_group: int, seed: int = 0
) -> DataFrame:
    """At most ``per_group`` rows of each group, the ones with the smallest hashed ids.

    Only rows below a hash that about twice as many pass are ranked, so that a large group
    sends few. Rows with a NULL id or group are left out.
    """
    known = df.filter(F.col(id_col).isNotNull())
    for g in groups:
        known = known.filter(F.col(g).isNotNull())
    share = F.least(F.lit(2.0 * per_group + 100) / F.count("*"), F.lit(1.0))
    limits = known.groupBy(*groups).agg((share * 2.0**64 - 2.0**63).alias("_limit"))
    hashed = known.withColumn("_hash", F.xxhash64(F.col(id_col), F.lit(seed)))
    # one row for each group: sent to all tasks if there are few, so that most rows are never shuffled
    limits = stored(limits, "limits")
    limits = F.broadcast(limits) if limits.count() <= SENT_GROUPS else limits
    few = hashed.join(limits, groups).filter(F.col("_hash").cast("double") <= F.col("_limit"))
    order = Window.partitionBy(*groups).orderBy("_hash", id_col)
    ranked = few.withColumn("_rank", F.row_number().over(order))
    return ranked.filter(F.col("_rank") <= per_group).drop("_rank", "_hash", "_limit")


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """The rows with their place (from 0) in the order of ``order``.

    Rows are dealt by ranges of the order and numbered there; the sizes of the ranges give
    where each starts. Rows that ``order`` ties are numbered in any order among themselves.
    The result is written, so the numbers do not change when a task runs again.
    """
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = stored(spread.withColumn("_at", F.monotonically_increasing_id()), "numbered")
    placed = placed.withColumn("_part", F.shiftright("_at", 33))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    starts = starts.select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    # one row for each partition of the shuffle
    found = placed.join(F.broadcast(starts), "_part")
    within = F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return found.withColumn(name, within + F.col("_before")).drop("_at", "_part", "_before")


def blocks(data: bytes, size: int, stop: bytes) -> Iterator[bytes]:
    """``data`` in pieces of about ``size`` bytes, cut before ``stop``."""
    at = 0
    while at < len(data):
        end = data.find(stop, at + size)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end
