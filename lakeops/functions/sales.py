"""Commission rule as a column expression (no Python worker)."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.numbers import as_column

# Fixed values of the commission rule, in percent: base rate, extra for a sale above the
# amount, extra for an employee hired more than so many days before the sale.
BASE_PERCENT = 3
LARGE_SALE_PERCENT, LARGE_SALE_AMOUNT = 2, 1000
TENURE_PERCENT, TENURE_DAYS = 1, 180


def commission_percent(
    amount: Column | str, sale_date: Column | str, hire_date: Column | str
) -> Column:
    """Whole percent; an unknown amount counts as 0, an unknown date as short tenure."""
    tenure = F.datediff(as_column(sale_date), as_column(hire_date))
    return (
        F.lit(BASE_PERCENT)
        + F.when(as_column(amount) > LARGE_SALE_AMOUNT, LARGE_SALE_PERCENT).otherwise(0)
        + F.when(tenure > TENURE_DAYS, TENURE_PERCENT).otherwise(0)
    )


def commission_rate(
    amount: Column | str, sale_date: Column | str, hire_date: Column | str
) -> Column:
    """Rate as a fraction, for example 0.05."""
    return commission_percent(amount, sale_date, hire_date) / F.lit(100.0)


def commission(amount: Column | str, percent: Column | str) -> Column:
    """Commission on the whole amount (nine decimals), rounded half up to cents once."""
    exact = as_column(amount).cast("decimal(28,9)") * as_column(percent).cast("decimal(3,0)")
    return F.round(exact * F.lit(Decimal("0.01")), 2).cast("double")
