"""Warehouse marts: game logs, season statistics and the sales reports."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeops.functions.dates import season_start_year
from lakeops.functions.numbers import exact_avg, exact_sum, round_to
from lakeops.operators.windows import with_previous_date

LOG_COUNTERS = (
    "points", "assists", "reboundsoffensive", "reboundsdefensive", "steals", "blocks", "turnovers",
)


def _player_name() -> Column:
    return F.concat(F.col("firstname"), F.lit(" "), F.col("lastname")).alias("player_name")


def game_logs(
    games: DataFrame, counters: Sequence[str] = LOG_COUNTERS, **limits
) -> DataFrame:
    """Played games with the date of the player's game before and a back-to-back flag.

    A counter that ``games`` lacks is an error; name fewer ``counters`` where there are fewer.
    """
    played = games.where(F.col("numminutes") > 0).select(
        "personid",
        _player_name(),
        "gameid",
        "playerteamname",
        *counters,
        F.col("numminutes").cast("double").alias("numminutes"),
        F.col("gamedatetimeest").cast("date").alias("game_date"),
    )
    return with_previous_date(played, ["personid"], ["game_date", "gameid"], "game_date", **limits)


def season_stats(
    games: DataFrame,
    salaries: DataFrame,
    match_season: bool = False,
    persons: DataFrame | None = None,
) -> DataFrame:
    """Totals and means per player, team and season, with the player's greatest salary.

    A traded player has one row per team. The salary is the greatest over all seasons, or
    with ``match_season`` over rows whose ``season_start_year`` is the same; 0 if unknown.
    Games are grouped first, so the join sees one row per player, team and season. Names and
    team may come from ``persons`` (one row each), which is joined after the grouping too.
    """
    rebounds = F.col("reboundsoffensive") + F.col("reboundsdefensive")
    named = [_player_name(), F.col("playerteamname")] if persons is None else []

    def mean(value: Column, name: str) -> Column:
        return round_to(F.avg(value.cast("double")), 1).alias(name)

    stats = (
        games.where(F.col("numminutes") > 0)
        .groupBy(
            "personid",
            *named,
            season_start_year("gamedatetimeest").cast("long").alias("season_start_year"),
        )
        .agg(
            F.count("gameid").alias("total_games_played"),
            F.sum("points").alias("total_points"),
            mean(F.col("points"), "avg_points"),
            F.sum("assists").alias("total_assists"),
            mean(F.col("assists"), "avg_assists"),
            F.sum(rebounds).alias("total_rebounds_sum"),
            mean(rebounds, "avg_rebounds"),
            *[F.sum(c).alias(f"total_{c}") for c in ("steals", "blocks", "turnovers")],
        )
    )
    if persons is not None:
        stats = stats.join(persons.select("personid", _player_name(), "playerteamname"), "personid")
    keys = ["personid", "season_start_year"] if match_season else ["personid"]
    greatest = salaries.groupBy(*keys).agg(F.max("salary_usd").alias("salary_usd"))
    return stats.join(greatest, keys, "left").withColumn(
        "salary_usd", F.coalesce(F.col("salary_usd"), F.lit(0))
    )


_EMPLOYEE = ("salespersonid", "employeefirstname", "employeelastname")
_PERIOD = ("year", "month")


def _newest_period(then: str, *ties: str) -> list[Column]:
    return [F.col("year").desc(), F.col("month").desc(), F.col(then).desc(), *map(F.col, ties)]


def sales_by_employee(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_EMPLOYEE)
        .agg(
            F.count("salesid").alias("total_transactions"),
            exact_sum("totalprice").alias("total_sales_amount"),
            F.sum("quantity").alias("total_quantity"),
            exact_avg("totalprice").alias("avg_sales_amount"),
            exact_sum("commission").alias("total_commissions"),
            exact_avg("discount").alias("avg_discount"),
        )
        .orderBy(F.col("total_sales_amount").desc(), "salespersonid")
    )


def sales_by_employee_period(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_PERIOD, *_EMPLOYEE)
        .agg(
            F.count("salesid").alias("transactions_in_period"),
            exact_sum("totalprice").alias("sales_amount_in_period"),
            F.sum("quantity").alias("quantity_in_period"),
            exact_sum("commission").alias("commission_in_period"),
        )
        .orderBy(*_newest_period("sales_amount_in_period", "salespersonid"))
    )


def sales_by_customer(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("customerid")
        .agg(
            F.count("salesid").alias("total_purchases"),
            exact_sum("totalprice").alias("total_spent"),
            F.sum("quantity").alias("total_items_bought"),
            exact_avg("totalprice").alias("avg_purchase_amount"),
            F.max("salesdate").alias("last_purchase_date"),
            F.min("salesdate").alias("first_purchase_date"),
        )
        .orderBy(F.col("total_spent").desc(), "customerid")
    )


def sales_by_customer_period(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_PERIOD, "customerid")
        .agg(
            F.count("salesid").alias("purchases_in_period"),
            exact_sum("totalprice").alias("spent_in_period"),
            F.sum("quantity").alias("items_in_period"),
            exact_avg("totalprice").alias("avg_purchase_in_period"),
        )
        .orderBy(*_newest_period("spent_in_period", "customerid"))
    )


def products_by_period(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_PERIOD, "productid")
        .agg(
            F.count("salesid").alias("times_sold"),
            F.sum("quantity").alias("quantity_sold"),
            exact_sum("totalprice").alias("total_revenue"),
            exact_avg("discount").alias("avg_discount"),
        )
        .orderBy(*_newest_period("total_revenue", "productid"))
    )


def products_global(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("productid")
        .agg(
            F.count("salesid").alias("times_sold"),
            F.sum("quantity").alias("total_quantity_sold"),
            exact_sum("totalprice").alias("total_revenue"),
            exact_avg("discount").alias("avg_discount"),
            F.max("salesdate").alias("last_sale_date"),
        )
        .orderBy(F.col("total_revenue").desc(), "productid")
    )


def products_by_customer(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy("customerid", "productid")
        .agg(
            F.count("salesid").alias("purchase_count"),
            F.sum("quantity").alias("total_quantity"),
            exact_sum("totalprice").alias("total_spent"),
            F.max("salesdate").alias("last_purchase_date"),
        )
        .orderBy("customerid", F.col("total_spent").desc(), "productid")
    )


def products_by_salesperson(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_EMPLOYEE, "productid")
        .agg(
            F.count("salesid").alias("sales_count"),
            F.sum("quantity").alias("total_quantity"),
            exact_sum("totalprice").alias("total_revenue"),
            exact_avg("discount").alias("avg_discount"),
        )
        .orderBy("salespersonid", F.col("total_revenue").desc(), "productid")
    )


def customers_by_salesperson(sales: DataFrame) -> DataFrame:
    """Two levels: revenue per customer, then per salesperson over customers."""
    per_customer = sales.groupBy(*_EMPLOYEE, "customerid").agg(
        exact_sum("totalprice").alias("revenue"),
        F.max("salesdate").alias("last_sale"),
    )
    return (
        per_customer.groupBy(*_EMPLOYEE)
        .agg(
            F.count("customerid").alias("total_unique_customers"),
            exact_sum("revenue").alias("total_revenue_from_all_customers"),
            exact_avg("revenue").alias("avg_revenue_per_customer"),
            F.max("last_sale").alias("last_sale_date"),
        )
        .orderBy(F.col("total_revenue_from_all_customers").desc(), "salespersonid")
    )


def performance_detailed(sales: DataFrame) -> DataFrame:
    return (
        sales.groupBy(*_PERIOD, *_EMPLOYEE, "customerid")
        .agg(
            F.count("salesid").alias("transactions"),
            F.sum("quantity").alias("quantity"),
            exact_sum("totalprice").alias("revenue"),
            exact_sum("commission").alias("commission"),
            exact_avg("discount").alias("avg_discount"),
        )
        .orderBy(
            F.col("year").desc(),
            F.col("month").desc(),
            "salespersonid",
            F.col("revenue").desc(),
            "customerid",
        )
    )


SALES_MARTS: dict[str, Callable[[DataFrame], DataFrame]] = {
    f.__name__: f
    for f in (
        sales_by_employee,
        sales_by_employee_period,
        sales_by_customer,
        sales_by_customer_period,
        products_by_period,
        products_global,
        products_by_customer,
        products_by_salesperson,
        customers_by_salesperson,
        performance_detailed,
    )
}
