"""Schema evolution and as-of reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeops.operators.dedupe import first_per_key
from lakeops.operators.history import (
    DELETE,
    VersionedTable,
    add_columns,
    drop_columns,
    filled_counts,
    schema_diff as diff_of_schemas,
)
from lakeops.operators.merge import update_matched
from lakeops.plans.registry import query
from lakeops.plans.views import Tables
from lakeops.workspace import new_folder

# Commit times of the three versions.
COMMITTED = {1: "2026-03-20 18:18:00", 2: "2026-03-21 18:18:00", 3: "2026-03-22 18:18:00"}


def _before(t: Tables) -> DataFrame:
    return t.read("customer").select(
        "c_custkey", "c_name", F.col("c_acctbal").alias("salary_usd"), "c_mktsegment"
    )


def _after(t: Tables) -> DataFrame:
    """Two season columns added and filled from each customer's first order; one dropped."""
    added = add_columns(_before(t), {"salary_2026_27": "double", "salary_2027_28": "double"})
    named = t.read("orders").join(
        t.read("customer").select("c_custkey", "c_name"), F.col("o_custkey") == F.col("c_custkey")
    )
    source = first_per_key(named, [F.lower("c_name")], ["o_orderkey"]).select(
        F.upper("c_name").alias("name"),
        "o_totalprice",
        F.when(F.col("o_orderstatus") == "O", F.col("o_totalprice")).alias("later"),
    )
    filled = update_matched(
        added, source, {"c_name": "name"}, {"salary_2026_27": "o_totalprice", "salary_2027_28": "later"}
    )
    return drop_columns(filled, ["c_mktsegment"])


_AFTER_SQL = """
    SELECT c.c_custkey, c.c_name, c.c_acctbal AS salary_usd, s.o_totalprice AS salary_2026_27,
           CASE WHEN s.o_orderstatus = 'O' THEN s.o_totalprice END AS salary_2027_28
    FROM customer c LEFT JOIN (
        SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn
                       FROM orders) o WHERE rn = 1) s ON c.c_custkey = s.o_custkey"""


@query(_AFTER_SQL)
def schema_evolve(t: Tables) -> DataFrame:
    return _after(t)


@query(
    f"""WITH a AS ({_AFTER_SQL}),
             n AS (SELECT count(c_custkey) AS k, count(c_name) AS n, count(c_acctbal) AS b,
                          count(c_mktsegment) AS m FROM customer),
             f AS (SELECT count(salary_2026_27) AS s1, count(salary_2027_28) AS s2 FROM a)
        SELECT 'c_custkey' AS column_name, 'bigint' AS type_before, 'bigint' AS type_after,
               'same' AS change, k AS filled_before, k AS filled_after FROM n
        UNION ALL SELECT 'c_name', 'string', 'string', 'same', n, n FROM n
        UNION ALL SELECT 'salary_usd', 'double', 'double', 'same', b, b FROM n
        UNION ALL SELECT 'c_mktsegment', 'string', NULL, 'dropped', m, NULL FROM n
        UNION ALL SELECT 'salary_2026_27', NULL, 'double', 'added', NULL, s1 FROM f
        UNION ALL SELECT 'salary_2027_28', NULL, 'double', 'added', NULL, s2 FROM f"""
)
def schema_diff(t: Tables) -> DataFrame:
    """Columns of both versions, with the values each version holds."""
    before, after = _before(t), _after(t)
    return (
        diff_of_schemas(before, after)
        .join(filled_counts(before, "filled_before"), "column_name", "left")
        .join(filled_counts(after, "filled_after"), "column_name", "left")
    )


def _versions(t: Tables) -> VersionedTable:
    """1: all customers. 2: balance and status of those with a new order. 3: customers that
    were in debt at first are deleted."""
    table = VersionedTable(t.spark, new_folder(t.spark, "balances"), ("c_custkey",))
    base = t.read("customer").select("c_custkey", "c_name", F.col("c_acctbal").alias("balance"))
    table.commit(base, 1, COMMITTED[1])
    orders = t.read("orders")
    recent = (
        orders.where(F.col("o_orderdate") >= F.lit("2000-01-01").cast("timestamp_ntz"))
        .groupBy(F.col("o_custkey").alias("c_custkey"))
        .agg(F.max("o_totalprice").alias("balance"), F.max("o_orderstatus").alias("last_status"))
    )
    table.commit(base.drop("balance").join(recent, "c_custkey"), 2, COMMITTED[2])
    table.commit(base.where("balance < 0").select("c_custkey"), 3, COMMITTED[3], DELETE)
    return table


_VERSION_2_SQL = """
    SELECT c.c_custkey, c.c_name, COALESCE(r.balance, c.c_acctbal) AS balance, r.last_status
    FROM customer c LEFT JOIN (SELECT o_custkey, MAX(o_totalprice) AS balance,
                                      MAX(o_orderstatus) AS last_status
                               FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
                               GROUP BY o_custkey) r ON c.c_custkey = r.o_custkey"""


@query(
    f"""SELECT CAST(1 AS BIGINT) AS version, TIMESTAMP '{COMMITTED[1]}' AS committed_at,
               'upsert' AS operation, count(*) AS changed_rows FROM customer
        UNION ALL SELECT 2, TIMESTAMP '{COMMITTED[2]}', 'upsert', COUNT(DISTINCT o_custkey) FROM orders
                  WHERE o_orderdate >= TIMESTAMP '2000-01-01 00:00:00'
                    AND o_custkey IN (SELECT c_custkey FROM customer)
        UNION ALL SELECT 3, TIMESTAMP '{COMMITTED[3]}', 'delete', count(*) FROM customer
                  WHERE c_acctbal < 0"""
)
def snapshot_log(t: Tables) -> DataFrame:
    return _versions(t).log()


@query(_VERSION_2_SQL)
def time_travel(t: Tables) -> DataFrame:
    """Customers as they were after version 2."""
    return _versions(t).as_of(2)


@query(
    f"""SELECT * FROM ({_VERSION_2_SQL}) v
        WHERE c_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)"""
)
def current_state(t: Tables) -> DataFrame:
    """Customers after the last version, deletions applied."""
    return _versions(t).latest()
