"""Write, lay out and read back tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import month_start
from lakeops.functions.numbers import exact_sum
from lakeops.operators.analytics import count_of
from lakeops.operators.history import add_columns
from lakeops.plans.registry import query
from lakeops.plans.views import SALES_VIEWS, Tables, box, sales
from lakeops.schemas import ALL_TABLES, DRIVER_TABLES
from lakeops.sources.bucketed import write_clustered
from lakeops.sources.files import (
    copy_table,
    ensure_table,
    read_csv,
    read_csv_lenient,
    read_csv_records,
    read_parquet_merged,
    storage_size as sizes_of,
    write_single_file,
    write_table,
)
from lakeops.workspace import new_folder

_PRICE = "CAST(SUM(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE)"


def _orders_report(orders: DataFrame, *by: str) -> DataFrame:
    return orders.groupBy(*by).agg(
        F.count("*").alias("orders"), exact_sum("o_totalprice").alias("revenue")
    )


@query(
    f"""SELECT o_orderstatus, CAST(year(o_orderdate) AS INT) AS year, count(*) AS orders,
               {_PRICE} AS revenue FROM orders GROUP BY 1, 2"""
)
def csv_roundtrip(t: Tables) -> DataFrame:
    """Orders written as CSV with header, read with a schema."""
    path = new_folder(t.spark, "orders-csv")
    write_table(t.read("orders"), path, fmt="csv")
    rows = read_csv(t.spark, path, DRIVER_TABLES["orders"])
    return _orders_report(rows.withColumn("year", F.year("o_orderdate")), "o_orderstatus", "year")


_TEXTS_SQL = r"""SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN 'a "b" \ ' || chr(10) || text || '\'
                             ELSE text END AS text FROM documents"""


def _odd_texts(t: Tables) -> DataFrame:
    """Documents with line breaks, quotes, backslashes, empty and NULL text."""
    kind = F.col("doc_id") % 5
    text = (
        F.when(kind == 0, F.lit(None).cast("string"))
        .when(kind == 1, F.lit(""))
        .when(kind == 2, F.concat(F.lit('a "b" \\ \n'), F.col("text"), F.lit("\\")))
        .otherwise(F.col("text"))
    )
    return t.spark.read.parquet(t.path("documents")).select("doc_id", text.alias("text"))


@query(_TEXTS_SQL)
def csv_text_roundtrip(t: Tables) -> DataFrame:
    """Odd texts through CSV, each file read by one task."""
    rows = _odd_texts(t)
    path = new_folder(t.spark, "documents-csv")
    write_table(rows, path, fmt="csv")
    return read_csv(t.spark, path, rows.schema, line_breaks=True)


@query(_TEXTS_SQL)
def csv_records_roundtrip(t: Tables) -> DataFrame:
    """Odd texts through CSV, records found by their quotes, each file read by many tasks."""
    rows = _odd_texts(t)
    path = new_folder(t.spark, "documents-csv")
    write_table(rows, path, fmt="csv")
    return read_csv_records(t.spark, path, rows.schema)


@query(
    f"""SELECT o_orderpriority, count(*) AS orders, {_PRICE} AS revenue,
               COUNT(DISTINCT o_custkey) AS customers, max(o_orderdate) AS last_order
        FROM orders GROUP BY 1"""
)
def csv_lenient_scan(t: Tables) -> DataFrame:
    """Orders written as CSV, read as text and cast column by column."""
    path = new_folder(t.spark, "orders-text")
    write_table(t.read("orders"), path, fmt="csv")
    rows = read_csv_lenient(t.spark, path, DRIVER_TABLES["orders"])
    return rows.groupBy("o_orderpriority").agg(
        F.count("*").alias("orders"),
        exact_sum("o_totalprice").alias("revenue"),
        F.count_distinct("o_custkey").alias("customers"),
        F.max("o_orderdate").alias("last_order"),
    )


# Files from this date on have the priority column, earlier files do not.
EVOLVED_FROM = "1998-01-01"


@query(
    f"""SELECT CASE WHEN o_orderdate >= TIMESTAMP '{EVOLVED_FROM} 00:00:00' THEN o_orderpriority END
                    AS o_orderpriority, count(*) AS orders, {_PRICE} AS revenue
        FROM orders GROUP BY 1"""
)
def merge_schema_scan(t: Tables) -> DataFrame:
    """Two sets of files with different columns, read as one table."""
    path = new_folder(t.spark, "orders-evolved")
    orders, start = t.read("orders"), F.lit(EVOLVED_FROM).cast("timestamp_ntz")
    old = orders.where(F.col("o_orderdate") < start).drop("o_orderpriority")
    write_table(old, f"{path}/part=1")
    write_table(orders.where(F.col("o_orderdate") >= start), f"{path}/part=2")
    return _orders_report(read_parquet_merged(t.spark, path), "o_orderpriority")


@query(
    """SELECT CAST(year(salesdate) AS INT) AS year, CAST(month(salesdate) AS INT) AS month,
              count(*) AS sales_count, CAST(SUM(totalprice) AS DOUBLE) AS revenue
       FROM sales GROUP BY 1, 2""",
    SALES_VIEWS,
)
def partitioned_write(t: Tables) -> DataFrame:
    """Sales by month; loading a month again replaces that month only."""
    rows = sales(t).withColumns({"year": F.year("salesdate"), "month": F.month("salesdate")})
    path = new_folder(t.spark, "sales-partitioned")
    write_table(rows, path, partition_by=["year", "month"])
    again = rows.where((F.col("year") == 1998) & (F.col("month") == 3))
    write_table(again, path, mode="overwrite", partition_by=["year", "month"], dynamic=True)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    return stored.groupBy("year", "month").agg(
        F.count("*").alias("sales_count"), exact_sum("totalprice").alias("revenue")
    )


@query(
    f"""SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS orders, {_PRICE} AS revenue
        FROM orders GROUP BY 1"""
)
def append_batch(t: Tables) -> DataFrame:
    """Two batches appended to one table."""
    path = new_folder(t.spark, "orders-appended")
    orders, cut = t.read("orders"), F.lit("1999-01-01").cast("timestamp_ntz")
    for batch in (F.col("o_orderdate") < cut, F.col("o_orderdate") >= cut):
        write_table(orders.where(batch), path, mode="append")
    rows = t.spark.read.schema(DRIVER_TABLES["orders"]).parquet(path)
    return _orders_report(rows.withColumn("year", F.year("o_orderdate")), "year")


@query(
    """SELECT l_returnflag, l_linestatus, count(*) AS lines,
              CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
       FROM lineitem GROUP BY 1, 2"""
)
def table_format_copy(t: Tables) -> DataFrame:
    """Line items copied to ORC, replacing an earlier copy, and queried by name in SQL."""
    path = new_folder(t.spark, "lineitem-orc")
    copy_table(t.read("lineitem"), path, "orc")
    t.spark.read.schema(DRIVER_TABLES["lineitem"]).orc(path).createOrReplaceTempView("lineitem_copy")
    return t.spark.sql(
        """SELECT l_returnflag, l_linestatus, count(*) AS lines,
                  CAST(SUM(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
           FROM lineitem_copy GROUP BY l_returnflag, l_linestatus"""
    )


@query(f"SELECT o_orderstatus, count(*) AS orders, {_PRICE} AS revenue FROM orders GROUP BY 1")
def empty_init(t: Tables) -> DataFrame:
    """A typed empty table is created once, then filled; creating it again keeps the rows."""
    path, schema = new_folder(t.spark, "orders-init"), DRIVER_TABLES["orders"]
    ensure_table(t.spark, path, schema)
    write_table(t.read("orders"), path, mode="append")
    ensure_table(t.spark, path, schema)
    return _orders_report(t.spark.read.schema(schema).parquet(path), "o_orderstatus")


@query(f"SELECT o_custkey, count(*) AS orders, {_PRICE} AS revenue FROM orders GROUP BY 1")
def single_file_write(t: Tables) -> DataFrame:
    """A report stored as one file while its row count is small."""
    report = _orders_report(t.read("orders"), "o_custkey")
    path = new_folder(t.spark, "report")
    write_single_file(report, path)
    return t.spark.read.schema(report.schema).parquet(path)


@query()
def storage_size(t: Tables) -> DataFrame:
    """Files and bytes per table."""
    return sizes_of(t.spark, {name: t.path(name) for name in ALL_TABLES})


@query(
    """SELECT 'team' AS filter, count(*) AS row_count FROM box WHERE playerteamname = 'NATION_7'
       UNION ALL SELECT 'person', count(*) FROM box WHERE personid = 7""",
    ["box"],
)
def data_skipping(t: Tables) -> DataFrame:
    """Box scores clustered by team and person, then counted for one team and for one person."""
    rows = box(t)
    path = new_folder(t.spark, "box-clustered")
    write_clustered(rows, path, ["playerteamname", "personid"], bloom={"personid": 100_000})
    stored = t.spark.read.schema(rows.schema).parquet(path)

    team = count_of(stored, "playerteamname", "NATION_7").withColumn("filter", F.lit("team"))
    person = count_of(stored, "personid", 7).withColumn("filter", F.lit("person"))
    return team.unionAll(person).select("filter", "row_count")


# Date ranges of the size tiers.
TIERS = {
    "season": ("2000-10-01", "2001-10-01"),
    "recent": ("1998-10-01", None),
    "full": (None, None),
}


@query(
    " UNION ALL ".join(
        f"SELECT '{name}' AS tier, count(*) AS row_count, CAST(SUM(points) AS BIGINT) AS total_points FROM box"
        f" WHERE gamedatetimeest >= TIMESTAMP '{low or '0001-01-01'} 00:00:00'"
        f" AND gamedatetimeest < TIMESTAMP '{high or '9999-01-01'} 00:00:00'"
        for name, (low, high) in TIERS.items()
    ),
    ["box"],
)
def tiers(t: Tables) -> DataFrame:
    """Box scores stored by month and read back for nested date ranges."""
    rows = box(t).withColumn("month", month_start("gamedatetimeest"))
    path = new_folder(t.spark, "box-by-month")
    order = ["playerteamname", F.col("gamedatetimeest").desc(), "personid"]
    write_table(rows, path, partition_by=["month"], sort_by=order)
    stored = t.spark.read.schema(rows.schema).parquet(path)
    parts = []
    for name, (low, high) in TIERS.items():
        tier = stored
        # both predicates: the month prunes directories, the timestamp filters rows
        if low:
            start = F.lit(low).cast("timestamp_ntz")
            tier = tier.where((F.col("month") >= month_start(start)) & (F.col("gamedatetimeest") >= start))
        if high:
            end = F.lit(high).cast("timestamp_ntz")
            tier = tier.where((F.col("month") <= month_start(end)) & (F.col("gamedatetimeest") < end))
        parts.append(
            tier.agg(F.count("*").alias("row_count"), F.sum("points").alias("total_points")).select(
                F.lit(name).alias("tier"), "row_count", "total_points"
            )
        )
    return parts[0].unionAll(parts[1]).unionAll(parts[2])


@query(
    """SELECT c_custkey, c_name, CAST(NULL AS DOUBLE) AS salary_2026_27 FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal FROM supplier"""
)
def union_evolved(t: Tables) -> DataFrame:
    """Rows of an old and a new schema together; old rows have no value in the new column."""
    old = t.read("customer").select("c_custkey", "c_name")
    new = t.read("supplier").select(
        F.col("s_suppkey").alias("c_custkey"),
        F.col("s_name").alias("c_name"),
        F.col("s_acctbal").alias("salary_2026_27"),
    )
    return add_columns(old, {"salary_2026_27": "double"}).unionByName(new)
