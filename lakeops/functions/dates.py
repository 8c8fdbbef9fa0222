"""Date, season and period helpers as column expressions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from lakeops.functions.numbers import as_column

# Seasons start in October; the first period of an empty status.
SEASON_FIRST_MONTH = 10
FIRST_PERIOD = "2018-01"


def lenient_timestamp(text: Column | str, fmt: str | None = None) -> Column:
    """Text to TIMESTAMP_NTZ; bad text is NULL.

    Text is matched first, as a cast that fails is far dearer.
    """
    col = as_column(text)
    if fmt is None:
        return F.when(col.rlike(STAMP), col.try_cast("timestamp_ntz"))
    return F.when(
        col.rlike(_shape(fmt)), F.try_to_timestamp(col, F.lit(fmt)).cast("timestamp_ntz")
    )


# How a timestamp begins, and what its time may hold.
STAMP = r"^\s*[+-]?[0-9]{4,6}(-[0-9]{1,2}){0,2}([ T][0-9:. ]*([A-Za-z+-].*)?)?\s*$"


def _shape(fmt: str) -> str:
    """A pattern that every text of the format matches."""
    fields = re.sub(r"[yMdHhms]+", "\0", re.sub(r"'[^']*'|[A-LN-Za-cefgi-ln-rt-xz]+", "\1", fmt))
    parts = {"\0": "[0-9A-Za-z+-]+", "\1": ".*"}
    return "^" + "".join(parts.get(c) or re.escape(c) for c in fields) + "$"


def season_start_year(when: Column | str) -> Column:
    """Year in which the season of ``when`` began."""
    col = as_column(when)
    return F.when(F.month(col) >= SEASON_FIRST_MONTH, F.year(col)).otherwise(F.year(col) - 1)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(as_column(later), as_column(earlier))


def period(when: Column | str) -> Column:
    """Month of a date as ``yyyy-MM``."""
    return F.date_format(as_column(when), "yyyy-MM")


def next_period(last: Column | str, first: str = FIRST_PERIOD) -> Column:
    """The month after ``last`` (``yyyy-MM``); ``first`` when there is none yet."""
    start = F.concat(as_column(last), F.lit("-01")).cast("date")
    return F.coalesce(F.date_format(F.add_months(start, 1), "yyyy-MM"), F.lit(first))


def month_start(when: Column | str) -> Column:
    """First day of the month, the layout column of month-partitioned tables."""
    return F.trunc(as_column(when), "month")
