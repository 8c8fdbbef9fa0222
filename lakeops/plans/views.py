"""Views over the driver's tables: box scores, schedule, sales, employees, salaries.

Each view exists twice, as a DataFrame and as SQL text for the comparison engine.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeops.functions.numbers import exact_sum
from lakeops.functions.sales import commission, commission_percent
from lakeops.operators.dedupe import first_per_key
from lakeops.operators.joins import enrich_left
from lakeops.schemas import DRIVER_TABLES

@dataclass(frozen=True)
class Tables:
    """The driver's tables of one scale factor."""

    spark: SparkSession
    sf_dir: str

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def read(self, name: str) -> DataFrame:
        return self.spark.read.schema(DRIVER_TABLES[name]).parquet(self.path(name))


def _name_parts(name: str) -> tuple:
    part = lambda i: F.split_part(F.col(name), F.lit("#"), F.lit(i))
    return part(1), part(2)


def _lines_of(line: DataFrame) -> DataFrame:
    """Box scores without the persons' names and teams."""
    whole = F.col("l_quantity").cast("int")
    defensive = F.floor(F.col("l_discount") * 100 + 0.5).cast("int")
    offensive = F.floor(F.col("l_tax") * 100 + 0.5).cast("int")
    return line.select(
        F.col("l_suppkey").alias("personid"),
        F.col("l_orderkey").alias("gameid"),
        F.col("l_linenumber").alias("linenumber"),
        F.col("l_shipdate").alias("gamedatetimeest"),
        whole.alias("points"),
        F.col("l_linenumber").alias("assists"),
        defensive.alias("reboundsdefensive"),
        offensive.alias("reboundsoffensive"),
        whole.alias("fieldgoalsmade"),
        (whole + F.col("l_linenumber")).alias("fieldgoalsattempted"),
        offensive.alias("threepointersmade"),
        (offensive + defensive).alias("threepointersattempted"),
        F.col("l_linenumber").alias("freethrowsmade"),
        (F.col("l_linenumber") + defensive).alias("freethrowsattempted"),
        (whole % 48).alias("numminutes"),
        F.col("l_extendedprice").alias("price"),
    )


def lines(t: Tables) -> DataFrame:
    """Box scores with the persons' ids alone, for reports that group before they join."""
    return _lines_of(t.read("lineitem"))


def persons(t: Tables) -> DataFrame:
    """One row per person: names, split once each, and team. Dimensions are joined first."""
    first, last = _name_parts("s_name")
    named = t.read("supplier").select(
        F.col("s_suppkey").alias("personid"),
        first.alias("firstname"),
        last.alias("lastname"),
        "s_nationkey",
    )
    teams = t.read("nation").select(
        F.col("n_nationkey").alias("s_nationkey"), F.col("n_name").alias("playerteamname")
    )
    return named.join(teams, "s_nationkey").drop("s_nationkey")


def _box_of(line: DataFrame, t: Tables) -> DataFrame:
    return _lines_of(line).join(persons(t), "personid")


def box(t: Tables, min_points: int | None = None) -> DataFrame:
    """Box scores. ``min_points`` is applied to the scanned column, so it reaches the file."""
    line = t.read("lineitem")
    if min_points is not None:
        line = line.where(F.col("l_quantity") >= float(min_points))
    return _box_of(line, t)


def games(t: Tables) -> DataFrame:
    """Latest box score per person and game. Every person is in one team, so lines are
    deduplicated before the join."""
    newest = [F.col(c).desc() for c in _GAME_NEWEST]
    return _box_of(first_per_key(t.read("lineitem"), ["l_suppkey", "l_orderkey"], newest), t)


def game_lines(t: Tables) -> DataFrame:
    """``games`` without the persons' names and teams."""
    newest = [F.col(c).desc() for c in _GAME_NEWEST]
    return _lines_of(first_per_key(t.read("lineitem"), ["l_suppkey", "l_orderkey"], newest))


_GAME_NEWEST = ("l_shipdate", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")


def sched(t: Tables) -> DataFrame:
    return t.read("orders").select(
        F.col("o_orderkey").alias("gameid"),
        F.col("o_orderpriority").alias("arenaname"),
        F.year("o_orderdate").cast("string").alias("arenacity"),
        F.col("o_orderstatus").alias("gamelabel"),
    )


def ratings(t: Tables) -> DataFrame:
    """Advanced statistics, one row per person and game, with typed ids."""
    return (
        t.read("lineitem")
        .groupBy(F.col("l_suppkey").alias("personid"), F.col("l_orderkey").alias("gameid"))
        .agg(
            (F.max("l_discount") * 10).alias("tspct"),
            (F.max("l_tax") * 10).alias("usgpct"),
            (F.max("l_quantity") / F.lit(100.0)).alias("pie"),
            F.max("l_extendedprice").alias("offrating"),
            F.min("l_extendedprice").alias("defrating"),
        )
        .withColumn("netrating", F.col("offrating") - F.col("defrating"))
    )


def adv(t: Tables) -> DataFrame:
    """``ratings`` with names; the game id is text."""
    person = F.col("personid")
    return ratings(t).select(
        "personid",
        F.col("gameid").cast("string").alias("gameid"),
        F.concat(F.lit("Player "), person.cast("string")).alias("playername"),
        F.concat(F.lit("Team "), (person % 30).cast("string")).alias("teamname"),
        "tspct", "usgpct", "pie", "offrating", "defrating", "netrating",
    )


_SALE_KEYS = ("l_orderkey", "l_linenumber")
_SALE_NEWEST = (
    "l_shipdate", "l_extendedprice", "l_partkey", "l_suppkey", "l_quantity", "l_discount",
)


def _sales_of(line: DataFrame, t: Tables) -> DataFrame:
    return line.join(t.read("orders"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("salesid"),
        F.col("l_shipdate").alias("salesdate"),
        F.col("l_suppkey").alias("salespersonid"),
        F.col("o_custkey").alias("customerid"),
        F.col("l_partkey").alias("productid"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("totalprice"),
        F.col("l_discount").alias("discount"),
    )


def sales_raw(t: Tables) -> DataFrame:
    return _sales_of(t.read("lineitem"), t)


def sales(t: Tables) -> DataFrame:
    """One row per sale. Every order has one customer, so lines are deduplicated before the
    join: fewer rows to shuffle, and at most a few lines per order are left."""
    newest = [F.col(c).desc() for c in _SALE_NEWEST]
    return _sales_of(first_per_key(t.read("lineitem"), list(_SALE_KEYS), newest), t)


def emp(t: Tables) -> DataFrame:
    first, last = _name_parts("s_name")
    hired = F.date_add(F.lit("1995-01-01").cast("date"), (F.col("s_suppkey") * 17 % 2000).cast("int"))
    return t.read("supplier").select(
        F.col("s_suppkey").alias("employeeid"),
        first.alias("firstname"),
        last.alias("lastname"),
        hired.alias("hiredate"),
    )


def sales_processed(t: Tables) -> DataFrame:
    """Deduplicated sales with employee, commission and period."""
    joined = enrich_left(
        sales(t), emp(t), "salespersonid", "employeeid", ["hiredate", "firstname", "lastname"]
    )
    return (
        joined.withColumn("percent", commission_percent("totalprice", "salesdate", "hiredate"))
        .select(
            "salesid",
            "salesdate",
            F.year("salesdate").alias("year"),
            F.month("salesdate").alias("month"),
            "salespersonid",
            F.col("firstname").alias("employeefirstname"),
            F.col("lastname").alias("employeelastname"),
            "hiredate", "customerid", "productid", "quantity", "totalprice", "discount",
            (F.col("percent") / F.lit(100.0)).alias("commissionrate"),
            commission("totalprice", "percent").alias("commission"),
        )
    )


def salary_wide(t: Tables) -> DataFrame:
    """One column y<year> for each year of the orders: the years are read from the data."""
    orders = t.read("orders").withColumn("year", F.year("o_orderdate"))
    years = sorted(r.year for r in orders.select("year").distinct().collect() if r.year is not None)
    return orders.groupBy(F.col("o_custkey").alias("personid")).agg(
        *[exact_sum(F.when(F.col("year") == y, F.col("o_totalprice"))).alias(f"y{y}") for y in years]
    )


VIEW_SQL = {
    "box": """
        SELECT l.l_suppkey AS personid, split_part(s.s_name, '#', 1) AS firstname,
               split_part(s.s_name, '#', 2) AS lastname, n.n_name AS playerteamname,
               l.l_orderkey AS gameid, l.l_linenumber AS linenumber, l.l_shipdate AS gamedatetimeest,
               CAST(l.l_quantity AS INT) AS points, l.l_linenumber AS assists,
               CAST(ROUND(l.l_discount * 100) AS INT) AS reboundsdefensive,
               CAST(ROUND(l.l_tax * 100) AS INT) AS reboundsoffensive,
               CAST(l.l_quantity AS INT) AS fieldgoalsmade, CAST(l.l_quantity AS INT) + l.l_linenumber AS fieldgoalsattempted,
               CAST(ROUND(l.l_tax * 100) AS INT) AS threepointersmade,
               CAST(ROUND(l.l_tax * 100) AS INT) + CAST(ROUND(l.l_discount * 100) AS INT) AS threepointersattempted,
               l.l_linenumber AS freethrowsmade,
               l.l_linenumber + CAST(ROUND(l.l_discount * 100) AS INT) AS freethrowsattempted,
               CAST(l.l_quantity AS INT) % 48 AS numminutes,
               l.l_extendedprice AS price
        FROM lineitem l JOIN supplier s ON l.l_suppkey = s.s_suppkey
        JOIN nation n ON s.s_nationkey = n.n_nationkey""",
    "sched": """
        SELECT o_orderkey AS gameid, o_orderpriority AS arenaname,
               CAST(year(o_orderdate) AS VARCHAR) AS arenacity, o_orderstatus AS gamelabel
        FROM orders""",
    "adv": """
        SELECT l_suppkey AS personid, CAST(l_orderkey AS VARCHAR) AS gameid,
               MAX(l_discount) * 10 AS tspct, MAX(l_tax) * 10 AS usgpct,
               MAX(l_quantity) / CAST(100 AS DOUBLE) AS pie,
               'Player ' || CAST(l_suppkey AS VARCHAR) AS playername, 
               'Team ' || CAST(l_suppkey % 30 AS VARCHAR) AS teamname,
               MAX(l_extendedprice) AS offrating, MIN(l_extendedprice) AS defrating,
               MAX(l_extendedprice) - MIN(l_extendedprice) AS netrating
        FROM lineitem GROUP BY l_suppkey, l_orderkey""",
    "sales_raw": """
        SELECT l.l_orderkey * 10 + l.l_linenumber AS salesid, l.l_shipdate AS salesdate,
               l.l_suppkey AS salespersonid, o.o_custkey AS customerid, l.l_partkey AS productid,
               CAST(l.l_quantity AS INT) AS quantity,
               CAST(l.l_extendedprice AS DECIMAL(18,9)) AS totalprice,
               CAST(l.l_discount AS DECIMAL(18,9)) AS discount
        FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""",
    "sales": """
        SELECT salesid, salesdate, salespersonid, customerid, productid, quantity, totalprice, discount
        FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY salesid
                 ORDER BY salesdate DESC, totalprice DESC, productid DESC, salespersonid DESC,
                          quantity DESC, discount DESC) AS rn FROM sales_raw) t
        WHERE rn = 1""",
    "emp": """
        SELECT s_suppkey AS employeeid, split_part(s_name, '#', 1) AS firstname,
               split_part(s_name, '#', 2) AS lastname,
               DATE '1995-01-01' + CAST((s_suppkey * 17) % 2000 AS INT) AS hiredate
        FROM supplier""",
    "sales_processed": """
        SELECT s.salesid, s.salesdate, CAST(year(s.salesdate) AS INT) AS year,
               CAST(month(s.salesdate) AS INT) AS month, s.salespersonid,
               e.firstname AS employeefirstname, e.lastname AS employeelastname, e.hiredate,
               s.customerid, s.productid, s.quantity, s.totalprice, s.discount,
               CAST(0.03 + CASE WHEN s.totalprice > 1000 THEN 0.02 ELSE 0 END
                    + CASE WHEN date_diff('day', e.hiredate, CAST(s.salesdate AS DATE)) > 180
                           THEN 0.01 ELSE 0 END AS DECIMAL(3,2)) AS commissionrate,
               CAST(ROUND(CAST(s.totalprice AS DECIMAL(28,9))
                    * CAST(0.03 + CASE WHEN s.totalprice > 1000 THEN 0.02 ELSE 0 END
                    + CASE WHEN date_diff('day', e.hiredate, CAST(s.salesdate AS DATE)) > 180
                           THEN 0.01 ELSE 0 END AS DECIMAL(3,2)), 2) AS DECIMAL(18,2)) AS commission
        FROM sales s LEFT JOIN emp e ON s.salespersonid = e.employeeid""",
    "salaries": """
        SELECT personid, y || '-' || lpad(CAST((y + 1) % 100 AS VARCHAR), 2, '0') AS season,
               CAST(total AS DOUBLE) AS salary_usd
        FROM (SELECT o_custkey AS personid, year(o_orderdate) AS y,
                     SUM(CAST(o_totalprice AS DECIMAL(18,9))) AS total
              FROM orders GROUP BY 1, 2) t
        WHERE total > 0""",
}

# Views each view is built from.
SALES_VIEWS = ("sales_raw", "sales")
PROCESSED_VIEWS = (*SALES_VIEWS, "emp", "sales_processed")
