"""File sources and sinks: CSV, Parquet, JSON and other formats by path."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.numbers import lenient_double, lenient_flag, lenient_int, lenient_long
from lakeops.functions.dates import lenient_timestamp


# Quotes inside text are doubled, so that backslashes stand for themselves; white space is text.
CSV = {
    "header": "true", "quote": '"', "escape": '"',
    "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false",
}


def csv_options(line_breaks: bool) -> dict[str, str]:
    """Reader options. With ``line_breaks`` text may hold them, but a file is read by one task."""
    return CSV | {"multiLine": str(line_breaks).lower()}


def _reads_empty_text(read: Callable[[str], DataFrame]) -> DataFrame:
    """What ``read`` (with a value for empty text in quotes) gives, with that text as it is.

    Spark would read it as NULL. The value is random, so that no text of the file equals it.
    """
    mark = f"empty-{uuid.uuid4().hex}"
    df = read(mark)
    return df.replace(mark, "", subset=[c for c, kind in df.dtypes if kind == "string"] or None)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType | None = None, line_breaks: bool = False
) -> DataFrame:
    """CSV with header. Without a schema the types are inferred, which reads the data twice.

    Files whose text may hold line breaks must be read with ``line_breaks``, or by
    ``read_csv_records`` if they are large. With a schema, empty text in quotes is empty text;
    without quotes, and without a schema, it is NULL.
    """
    reader = spark.read.options(**csv_options(line_breaks))
    if schema is None:
        return reader.option("inferSchema", "true").csv(path)
    return _reads_empty_text(lambda mark: reader.schema(schema).option("emptyValue", mark).csv(path))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(record) of CSV files whose text may hold line breaks, without their headers.

    A line starts a record if an even number of quotes stands before it in its file. Quotes are
    added up within each block of a file that one task reads (``maxPartitionBytes``), then over
    the blocks, so that many tasks read one file. A block's lines and a record's lines meet in
    one task; a file's do not. Quotes must stand around whole values and be doubled inside, as
    they are written here.
    """
    text = spark.read.option("lineSep", "\n").text(path)
    lines = text.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("at"),
        F.col("value").alias("line"),
    )
    along = Window.partitionBy("file", "block").orderBy("at")
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    before = F.coalesce(F.sum(quotes).over(along.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    lines = lines.withColumns({"quotes": quotes, "odd": before % 2})

    # one row per block: whether it starts inside quotes, and the last record begun before it
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = lines.groupBy("file", "block").agg(
        F.sum("quotes").alias("quotes"),
        F.count_if(F.col("odd") == 0).alias("even_lines"),
        F.count_if(F.col("odd") == 1).alias("odd_lines"),
    )
    blocks = blocks.withColumn("inside", F.coalesce(F.sum("quotes").over(earlier), F.lit(0)) % 2)
    begun = F.when(F.col("inside") == 0, F.col("even_lines")).otherwise(F.col("odd_lines"))
    blocks = blocks.withColumn("begun", begun)
    newest = F.when(F.col("begun") > 0, F.struct(F.col("block").alias("from"), F.col("begun").alias("record")))
    blocks = blocks.select(
        "file", "block", "inside", F.last(newest, ignorenulls=True).over(earlier).alias("open")
    )

    starts = (F.col("odd") == F.col("inside")).cast("long")
    placed = lines.join(blocks, ["file", "block"]).withColumn("record", F.sum(starts).over(along))
    here = F.struct(F.col("block").alias("from"), "record")
    placed = placed.select("file", F.when(F.col("record") > 0, here).otherwise(F.col("open")).alias("of"),
                           F.struct("block", "at", "line").alias("part"))
    whole = placed.groupBy("file", "of").agg(F.sort_array(F.collect_list("part"))["line"].alias("lines"))
    header = (F.col("of")["from"] == 0) & (F.col("of")["record"] == 1)
    record = F.regexp_replace(F.array_join("lines", "\n"), "\r$", "")
    return whole.where(~header).select(record.alias("record")).where("record <> ''")


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """``read_csv`` with ``line_breaks`` for large files: many tasks read one file.

    Values are read by position. Line ends inside text stay as they are.
    """
    records = csv_records(spark, path)
    options = {k: v for k, v in csv_options(True).items() if k != "header"}
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)

    def read(mark: str) -> DataFrame:
        row = F.from_csv("record", columns, options | {"emptyValue": mark})
        return records.select(row.alias("row")).select("row.*")

    return _reads_empty_text(read)


def lenient_select(
    df: DataFrame, schema: T.StructType, source_names: dict[str, str] | None = None
) -> DataFrame:
    """Text columns cast to ``schema``; what cannot be read is NULL.

    ``source_names`` maps a wanted name to the name it has in the file.
    """
    names = source_names or {}

    def cast(field: T.StructField) -> Column:
        text = F.col(names.get(field.name, field.name))
        kind = field.dataType
        if isinstance(kind, T.IntegerType):
            value = lenient_int(text)
        elif isinstance(kind, T.LongType):
            value = lenient_long(text)
        elif isinstance(kind, (T.DoubleType, T.FloatType)):
            value = lenient_double(text).cast(kind)
        elif isinstance(kind, T.BooleanType):
            value = lenient_flag(text)
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            value = lenient_timestamp(text).cast(kind)
        else:
            value = text.try_cast(kind)
        return value.alias(field.name)

    return df.select(*[cast(f) for f in schema.fields])


def read_csv_lenient(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    source_names: dict[str, str] | None = None,
    line_breaks: bool = False,
) -> DataFrame:
    """CSV read as text, then cast leniently to ``schema``; empty text as in ``read_csv``."""
    reader = spark.read.options(**csv_options(line_breaks)).option("inferSchema", "false")
    text = _reads_empty_text(lambda mark: reader.option("emptyValue", mark).csv(path))
    return lenient_select(text, schema, source_names)


def read_parquet_merged(spark: SparkSession, *paths: str) -> DataFrame:
    """Parquet files of different schemas as one frame; missing columns are NULL."""
    return spark.read.option("mergeSchema", "true").parquet(*paths)


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).json(path)


def read_period(table: DataFrame, year: int, month: int) -> DataFrame:
    """One month of a table partitioned by year and month; no rows when it is absent.

    The filter is on partition columns, so only that directory is read.
    """
    return table.where((F.col("year") == year) & (F.col("month") == month))


def available_periods(table: DataFrame) -> DataFrame:
    """Distinct (year, month); both are partition columns, so no data column is read."""
    return table.select("year", "month").distinct().orderBy("year", "month")


def write_table(
    df: DataFrame,
    path: str,
    *,
    mode: str = "errorifexists",
    fmt: str = "parquet",
    partition_by: Sequence[str] = (),
    sort_by: Sequence[str | Column] = (),
    dynamic: bool = False,
    options: dict[str, str] | None = None,
) -> None:
    """Write a table by path, with ``options`` of the format (compression, for example).

    A partitioned write is rebalanced on its partition columns first: few files per
    directory, while a directory with much of the data is still written by many tasks.
    ``dynamic`` replaces only the partitions present in ``df``.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    if sort_by:
        df = df.sortWithinPartitions(*partition_by, *sort_by)
    writer = df.write.mode(mode).format(fmt)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer = writer.options(**CSV)
    writer.options(**(options or {})).save(path)


def write_sorted(
    df: DataFrame, path: str, order: Sequence[str | Column], mode: str = "errorifexists"
) -> None:
    """Files cover disjoint ranges of ``order``, so min/max statistics skip most of them."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode(mode).parquet(path)


def write_single_file(df: DataFrame, path: str) -> None:
    """Overwrite ``path`` with one file, of any size: the last stage is one task.

    For reports that a reader wants as a file. Work before the last exchange is still
    distributed, as the rows meet in one task only to be written.
    """
    df.repartition(1).write.mode("overwrite").parquet(path)


def drop_table(spark: SparkSession, name: str) -> None:
    """Drop a table of the catalog by name, if there is one."""
    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:name)", args={"name": name})


def ensure_table(
    spark: SparkSession, path: str, schema: T.StructType, partition_by: Sequence[str] = ()
) -> None:
    """Create an empty table of that schema unless there is one."""
    writer = spark.createDataFrame([], schema).write.mode("ignore")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def copy_table(source: DataFrame, path: str, fmt: str) -> None:
    """Write a table in another format, replacing what is there."""
    write_table(source, path, mode="overwrite", fmt=fmt)


def file_sizes(spark: SparkSession, path: str, suffix: str = "") -> DataFrame:
    """(path, length) of the files of a table; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", f"*{suffix}")
        .load(path)
        .select("path", "length")
    )


def storage_size(spark: SparkSession, tables: dict[str, str]) -> DataFrame:
    """(table_name, files, bytes, size_mb) per table path."""
    parts = [
        file_sizes(spark, path).select(F.lit(name).alias("table_name"), "length")
        for name, path in tables.items()
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionAll(part)
    total = F.sum("length")
    return rows.groupBy("table_name").agg(
        F.count("*").alias("files"),
        total.alias("bytes"),
        F.round(total / F.lit(1024.0 * 1024.0), 3).alias("size_mb"),
    )
