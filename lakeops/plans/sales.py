"""Sales queries: clean, enrich, check, and the ten reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import days_between
from lakeops.functions.numbers import exact_sum
from lakeops.operators import marts
from lakeops.operators.aggregates import row_counts
from lakeops.operators.joins import with_child_count
from lakeops.operators.quality import checked_write, quality_report
from lakeops.plans.registry import query
from lakeops.plans.views import PROCESSED_VIEWS, SALES_VIEWS, Tables, emp, sales, sales_processed, sales_raw
from lakeops.workspace import stored
from lakeops.sources.files import write_table
from lakeops.workspace import new_folder

# Date that tenure is measured to, instead of the day of the run.
TENURE_DATE = "2002-01-01"


SALES_SQL = """
    SELECT salesid, salesdate, salespersonid, customerid, productid, quantity,
           CAST(totalprice AS DOUBLE) AS totalprice, CAST(discount AS DOUBLE) AS discount"""


@query(SALES_SQL + " FROM sales", SALES_VIEWS)
def sales_dedup(t: Tables) -> DataFrame:
    return sales(t)


@query(
    """SELECT salesid, salesdate, year, month, salespersonid, employeefirstname, employeelastname,
              hiredate, customerid, productid, quantity, CAST(totalprice AS DOUBLE) AS totalprice,
              CAST(discount AS DOUBLE) AS discount, CAST(commissionrate AS DOUBLE) AS commissionrate,
              CAST(commission AS DOUBLE) AS commission
       FROM sales_processed""",
    PROCESSED_VIEWS,
)
def sales_enriched(t: Tables) -> DataFrame:
    return sales_processed(t)


@query(
    """SELECT CAST(commissionrate AS DOUBLE) AS commissionrate, count(*) AS sales_count,
              CAST(SUM(commission) AS DOUBLE) AS total_commission
       FROM sales_processed GROUP BY commissionrate""",
    PROCESSED_VIEWS,
)
def commission(t: Tables) -> DataFrame:
    return (
        sales_processed(t)
        .groupBy("commissionrate")
        .agg(F.count("*").alias("sales_count"), exact_sum("commission").alias("total_commission"))
    )


@query(
    """SELECT c.c_custkey, c.c_name, COALESCE(n.total_purchases, 0) AS total_purchases
       FROM customer c LEFT JOIN (SELECT customerid, count(*) AS total_purchases FROM sales_raw
                                  GROUP BY customerid) n ON c.c_custkey = n.customerid""",
    ["sales_raw"],
)
def customer_purchases(t: Tables) -> DataFrame:
    """Purchases are counted on the raw sales, before duplicates are removed."""
    customers = t.read("customer").select("c_custkey", "c_name")
    return with_child_count(customers, sales_raw(t), "c_custkey", "total_purchases", "customerid")


@query(
    f"""SELECT employeeid, firstname, lastname, hiredate,
               CAST(date_diff('day', hiredate, DATE '{TENURE_DATE}') AS BIGINT) AS days_employed,
               date_diff('day', hiredate, DATE '{TENURE_DATE}') / CAST(365 AS DOUBLE) AS years_employed
        FROM emp""",
    ["emp"],
)
def tenure(t: Tables) -> DataFrame:
    days = days_between(F.lit(TENURE_DATE).cast("date"), "hiredate").cast("long")
    return emp(t).withColumns({"days_employed": days, "years_employed": days / F.lit(365.0)})


@query(
    """WITH m AS (SELECT count(*) AS total, COUNT(DISTINCT salesid) AS keys,
                         count(*) FILTER (WHERE totalprice > 0) AS positive,
                         count(*) FILTER (WHERE salesid IS NULL) AS n1,
                         count(*) FILTER (WHERE salesdate IS NULL) AS n2,
                         count(*) FILTER (WHERE totalprice IS NULL) AS n3 FROM sales_raw),
            r AS (SELECT 'duplicates' AS check_name, total AS expected, keys AS actual FROM m
                  UNION ALL SELECT 'positive_totalprice', total, positive FROM m
                  UNION ALL SELECT 'null_salesid', 0, n1 FROM m
                  UNION ALL SELECT 'null_salesdate', 0, n2 FROM m
                  UNION ALL SELECT 'null_totalprice', 0, n3 FROM m)
       SELECT check_name, CAST(expected AS BIGINT) AS expected, actual,
              CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status FROM r""",
    ["sales_raw"],
)
def quality_checks(t: Tables) -> DataFrame:
    """Checks on the raw sales, where the duplicate check must fail."""
    return quality_report(
        sales_raw(t), "salesid", "totalprice", ["salesid", "salesdate", "totalprice"]
    )


@query(
    """WITH m AS (SELECT count(*) AS total, count(*) FILTER (WHERE totalprice > 0) AS positive,
                         count(*) FILTER (WHERE salesid IS NULL) AS n1,
                         count(*) FILTER (WHERE salesdate IS NULL) AS n2,
                         count(*) FILTER (WHERE totalprice IS NULL) AS n3 FROM sales_raw),
            r AS (SELECT 'some_rows' AS check_name, greatest(total, 1) AS expected, total AS actual FROM m
                  UNION ALL SELECT 'positive_totalprice', total, positive FROM m
                  UNION ALL SELECT 'null_salesid', 0, n1 FROM m
                  UNION ALL SELECT 'null_salesdate', 0, n2 FROM m
                  UNION ALL SELECT 'null_totalprice', 0, n3 FROM m)
       SELECT check_name, CAST(expected AS BIGINT) AS expected, actual,
              CASE WHEN expected = actual THEN 'PASS' ELSE 'FAIL' END AS status FROM r""",
    ["sales_raw"],
)
def checks_while_writing(t: Tables) -> DataFrame:
    """The raw sales stored by month, and checked by the job that stores them."""
    rows = sales_raw(t).withColumns({"year": F.year("salesdate"), "month": F.month("salesdate")})
    path = new_folder(t.spark, "sales-checked")

    def write(df: DataFrame) -> None:
        write_table(df, path, partition_by=["year", "month"])

    return checked_write(rows, write, "totalprice", ["salesid", "salesdate", "totalprice"])


_EMPLOYEE = "salespersonid, employeefirstname, employeelastname"
_PRICE = "CAST(SUM(totalprice) AS DOUBLE)"
_AVG_PRICE = "CAST(SUM(totalprice) AS DOUBLE) / COUNT(totalprice)"
_QUANTITY = "CAST(SUM(quantity) AS BIGINT)"
_COMMISSION = "CAST(SUM(commission) AS DOUBLE)"
_AVG_DISCOUNT = "CAST(SUM(discount) AS DOUBLE) / COUNT(discount)"

# Report name: (grouping columns, measures as SQL).
REPORTS = {
    "sales_by_employee": (
        _EMPLOYEE,
        f"""COUNT(salesid) AS total_transactions, {_PRICE} AS total_sales_amount,
            {_QUANTITY} AS total_quantity, {_AVG_PRICE} AS avg_sales_amount,
            {_COMMISSION} AS total_commissions, {_AVG_DISCOUNT} AS avg_discount""",
    ),
    "sales_by_employee_period": (
        f"year, month, {_EMPLOYEE}",
        f"""COUNT(salesid) AS transactions_in_period, {_PRICE} AS sales_amount_in_period,
            {_QUANTITY} AS quantity_in_period, {_COMMISSION} AS commission_in_period""",
    ),
    "sales_by_customer": (
        "customerid",
        f"""COUNT(salesid) AS total_purchases, {_PRICE} AS total_spent,
            {_QUANTITY} AS total_items_bought, {_AVG_PRICE} AS avg_purchase_amount,
            MAX(salesdate) AS last_purchase_date, MIN(salesdate) AS first_purchase_date""",
    ),
    "sales_by_customer_period": (
        "year, month, customerid",
        f"""COUNT(salesid) AS purchases_in_period, {_PRICE} AS spent_in_period,
            {_QUANTITY} AS items_in_period, {_AVG_PRICE} AS avg_purchase_in_period""",
    ),
    "products_by_period": (
        "year, month, productid",
        f"""COUNT(salesid) AS times_sold, {_QUANTITY} AS quantity_sold,
            {_PRICE} AS total_revenue, {_AVG_DISCOUNT} AS avg_discount""",
    ),
    "products_global": (
        "productid",
        f"""COUNT(salesid) AS times_sold, {_QUANTITY} AS total_quantity_sold,
            {_PRICE} AS total_revenue, {_AVG_DISCOUNT} AS avg_discount,
            MAX(salesdate) AS last_sale_date""",
    ),
    "products_by_customer": (
        "customerid, productid",
        f"""COUNT(salesid) AS purchase_count, {_QUANTITY} AS total_quantity,
            {_PRICE} AS total_spent, MAX(salesdate) AS last_purchase_date""",
    ),
    "products_by_salesperson": (
        f"{_EMPLOYEE}, productid",
        f"""COUNT(salesid) AS sales_count, {_QUANTITY} AS total_quantity,
            {_PRICE} AS total_revenue, {_AVG_DISCOUNT} AS avg_discount""",
    ),
    "performance_detailed": (
        f"year, month, {_EMPLOYEE}, customerid",
        f"""COUNT(salesid) AS transactions, {_QUANTITY} AS quantity, {_PRICE} AS revenue,
            {_COMMISSION} AS commission, {_AVG_DISCOUNT} AS avg_discount""",
    ),
}

_REPORT_SQL = {
    name: f"SELECT {group}, {measures} FROM sales_processed GROUP BY {group}"
    for name, (group, measures) in REPORTS.items()
}
_REPORT_SQL["customers_by_salesperson"] = f"""
    SELECT {_EMPLOYEE}, COUNT(customerid) AS total_unique_customers,
           CAST(SUM(revenue) AS DOUBLE) AS total_revenue_from_all_customers,
           CAST(SUM(revenue) AS DOUBLE) / COUNT(revenue) AS avg_revenue_per_customer,
           MAX(last_sale) AS last_sale_date
    FROM (SELECT {_EMPLOYEE}, customerid, SUM(totalprice) AS revenue, MAX(salesdate) AS last_sale
          FROM sales_processed GROUP BY {_EMPLOYEE}, customerid) c
    GROUP BY {_EMPLOYEE}"""


def _register_report(name: str) -> None:
    def report(t: Tables) -> DataFrame:
        return marts.SALES_MARTS[name](sales_processed(t))

    report.__name__ = name
    query(_REPORT_SQL[name], PROCESSED_VIEWS)(report)


for _name in marts.SALES_MARTS:
    _register_report(_name)


@query(
    "WITH counts AS ("
    + " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM ({sql}) r"
        for name, sql in _REPORT_SQL.items()
    )
    + """) SELECT table_name, CAST(row_count AS BIGINT) AS row_count FROM counts
         UNION ALL SELECT 'TOTAL', CAST(SUM(row_count) AS BIGINT) FROM counts""",
    PROCESSED_VIEWS,
)
def table_summary(t: Tables) -> DataFrame:
    """Rows of each report. Sales are processed and stored once, then read by every report."""
    processed = stored(sales_processed(t), "sales-processed")
    return row_counts({name: report(processed) for name, report in marts.SALES_MARTS.items()})
