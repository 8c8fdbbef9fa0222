"""Sales: landing to processed tables and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.dates import days_between
from lakeops.functions.sales import commission, commission_percent
from lakeops.operators import marts
from lakeops.operators.dedupe import drop_duplicates_stable
from lakeops.operators.incremental import append_status, current_status, run_record
from lakeops.operators.joins import enrich_left, with_child_count
from lakeops.operators.quality import quality_report
from lakeops.sources.files import read_parquet_merged, write_single_file, write_table
from lakeops.sources.layers import Lake

# Reports stored by year and month.
PERIOD_REPORTS = (
    "sales_by_employee_period", "sales_by_customer_period", "products_by_period", "performance_detailed",
)


def first_open_month(spark: SparkSession, status: str) -> str | None:
    """The month (``yyyy-MM``) that the newest run reached, which may have got more sales since.

    None if there was no run yet: then everything is open.
    """
    try:
        last = current_status(spark, status).first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return last.last_processed_month if last else None


def from_month(rows: DataFrame, month: str | None, date: str = "SalesDate") -> DataFrame:
    """Rows of ``month`` and later, of all months if it is None; the filter reaches the scan."""
    if month is None:
        return rows
    return rows.where(F.col(date) >= F.lit(f"{month}-01").cast(rows.schema[date].dataType))


def from_period(table: DataFrame, month: str | None) -> DataFrame:
    """``from_month`` for a table partitioned by year and month: earlier folders are not read."""
    if month is None:
        return table
    year, number = map(int, month.split("-"))
    return table.where((F.col("year") > year) | ((F.col("year") == year) & (F.col("month") >= number)))


def process_sales(
    spark: SparkSession, lake: Lake, *, run: int, timestamp: str, as_of: str, full: bool = False
) -> DataFrame:
    """Landed sales, employees and customers to processed tables and the ten reports.

    The status decides the work: sales of the last processed month and later are processed,
    and of the reports by month those months are replaced; the other reports cover all months.
    With ``full``, for changes in earlier months, everything is done again. Repeated lines of
    a sale must lie in the months that a run processes. ``as_of`` is the date that tenure is
    measured to. Returns the quality report of the processed sales.
    """
    status = lake.path("processed", "_processing_status")
    month = None if full else first_open_month(spark, status)
    landed = read_parquet_merged(spark, lake.path("landing", "sales"))
    raw = from_month(landed, month)
    employees = read_parquet_merged(spark, lake.path("landing", "employees"))
    customers = read_parquet_merged(spark, lake.path("landing", "customers"))

    joined = enrich_left(
        drop_duplicates_stable(raw, ["SalesID"]),
        employees,
        "SalesPersonID",
        "EmployeeID",
        ["HireDate", "FirstName", "LastName"],
    ).withColumn("percent", commission_percent("TotalPrice", "SalesDate", "HireDate"))
    processed = joined.select(
        "SalesID",
        "SalesDate",
        F.year("SalesDate").alias("year"),
        F.month("SalesDate").alias("month"),
        "SalesPersonID",
        F.col("FirstName").alias("EmployeeFirstName"),
        F.col("LastName").alias("EmployeeLastName"),
        "HireDate", "CustomerID", "ProductID", "Quantity", "TotalPrice", "Discount",
        (F.col("percent") / F.lit(100.0)).alias("CommissionRate"),
        commission("TotalPrice", "percent").alias("Commission"),
    )
    path = lake.path("processed", "sales")
    write_table(processed, path, mode="overwrite", partition_by=["year", "month"], dynamic=True)
    stored = spark.read.schema(processed.schema).parquet(path)

    record = run_record(
        from_period(stored, month),
        "SalesDate",
        seq=run,
        timestamp=timestamp,
        source=lake.path("landing", "sales"),
        destination=path,
        partitions=["year", "month"],
    )
    reached = F.coalesce("last_processed_month", F.lit(month))  # a run may find nothing new
    append_status(status, record.withColumn("last_processed_month", reached))

    days = days_between(F.lit(as_of).cast("date"), "HireDate")
    tenure = employees.withColumn("DaysEmployed", days).withColumn("YearsEmployed", days / F.lit(365.0))
    write_single_file(tenure, lake.path("processed", "employees"))
    counted = with_child_count(
        drop_duplicates_stable(customers, ["CustomerID"]), landed, "CustomerID", "TotalPurchases"
    )
    write_single_file(counted, lake.path("processed", "customers"))

    for name, report in marts.SALES_MARTS.items():
        by_month = name in PERIOD_REPORTS
        write_table(
            report(from_period(stored, month) if by_month else stored),
            lake.path("processed", name),
            mode="overwrite",
            partition_by=["year", "month"] if by_month else [],
            dynamic=by_month and month is not None,
        )
    return quality_report(stored, "SalesID", "TotalPrice", ["SalesID", "SalesDate", "TotalPrice"])
