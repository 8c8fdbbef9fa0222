"""Tables that are replaced as a whole: written aside, checked, then published by one row."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.sources.files import write_table

VERSIONS = T.StructType().add("version", "long").add("folder", "string")


def _named(path: str) -> str:
    return f"{path.rstrip('/')}/_published"


def versions(spark: SparkSession, path: str) -> DataFrame:
    """(version, folder) of all that was published at ``path``, newest first."""
    try:
        rows = spark.read.schema(VERSIONS).json(_named(path))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], VERSIONS)
    return rows.orderBy(F.col("version").desc(), F.col("folder").desc())


def published_path(spark: SparkSession, path: str) -> str:
    """Folder of the newest version; ``path`` itself while nothing was published."""
    newest = versions(spark, path).first()
    return f"{path.rstrip('/')}/{newest.folder}" if newest else path


def read_published(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """The newest version. A frame made before a later refresh goes on reading its own version."""
    reader = spark.read.schema(schema) if schema else spark.read
    return reader.parquet(published_path(spark, path))


def publish(
    rows: DataFrame,
    path: str,
    *,
    check: Callable[[DataFrame], object] | None = None,
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str | Column] = (),
) -> int:
    """Replace the table at ``path`` and return the number of its new version.

    The rows are written to a folder of their own and read back by ``check``, which raises if
    they must not be shown. Only then is the folder named by one appended row, so readers see
    the old version or the new one, never a part, and a refresh that fails changes nothing.
    ``rows`` may read the table itself. Of two refreshes at once both are kept as versions and
    the greater folder name of the same number is shown. Folders start with an underscore:
    plain readers of ``path`` do not see them. Remove old ones by age.
    """
    spark = rows.sparkSession
    newest = versions(spark, path).first()
    version = (newest.version if newest else 0) + 1
    folder = f"_version-{version:09d}-{uuid.uuid4().hex}"
    target = f"{path.rstrip('/')}/{folder}"
    write_table(rows, target, partition_by=partition_by, sort_by=sort_by)
    if check:
        check(spark.read.schema(rows.schema).parquet(target))
    record = spark.createDataFrame([(version, folder)], VERSIONS).coalesce(1)
    write_table(record, _named(path), mode="append", fmt="json")
    return version
