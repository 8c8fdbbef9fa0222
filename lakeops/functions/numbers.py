"""Number helpers as column expressions."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


#: Up to these sizes nine decimals fit into a long, and into a decimal of 38 digits.
_IN_LONG, _IN_DECIMAL = 1e8, 1e18
_NANO = 1_000_000_000


def round_to(value: Column | str, digits: int = 2) -> Column:
    """Round half up on nine decimals, so that engines agree on binary fractions.

    Numbers from 1e18 on, infinities and NaN are rounded as doubles.
    """
    col = as_column(value).cast("double")
    return (
        F.when(F.abs(col) < _IN_LONG, F.round(col.cast("decimal(18,9)"), digits).cast("double"))
        .when(F.abs(col) < _IN_DECIMAL, F.round(col.cast("decimal(38,9)"), digits).cast("double"))
        .otherwise(F.round(col, digits))
    )


#: Numbers below this in size are added up exactly, in limbs of so many bits.
_EXACT, _LIMB = 1e18, 15
_MASK = (1 << _LIMB) - 1


def _limbs(col: Column) -> tuple[list[Column], list[Column]]:
    """The limbs of a number's whole part (4, the last with the sign) and of its billionths (2)."""
    small = F.when(F.abs(col) < _EXACT, col)
    whole = F.floor(small)
    billionths = F.floor((small - whole) * _NANO + 0.5).cast("bigint")

    def cut(number: Column, parts: int) -> list[Column]:
        low = [F.shiftright(number, _LIMB * i).bitwiseAND(F.lit(_MASK)) for i in range(parts - 1)]
        return low + [F.shiftright(number, _LIMB * (parts - 1))]

    return cut(whole, 4), cut(billionths, 2)


def _carried(sums: list[Column]) -> Column:
    """The number whose limbs have these sums, as a decimal without fraction."""
    parts = [s.cast("decimal(19,0)") * F.lit(Decimal(1 << _LIMB * i)) for i, s in enumerate(sums)]
    return sum(parts[1:], parts[0]).cast("decimal(38,0)")


def exact_total(whole: list[Column], billionths: list[Column]) -> Column:
    """The DOUBLE next to the number with these sums of limbs; NULL if they are NULL."""
    nano = F.lit(Decimal(_NANO))
    units = _carried(billionths)
    over = F.call_function("div", units, nano)
    rest = (units - over.cast("decimal(19,0)") * nano).cast("decimal(9,0)")
    total = (_carried(whole) + over.cast("decimal(19,0)")).cast("decimal(38,0)")
    exact = total.cast("decimal(28,0)") + rest * F.lit(Decimal(1).scaleb(-9))
    return F.when(F.abs(total) < F.lit(Decimal(10**28)), exact.cast("double")).otherwise(total.cast("double"))


def exact_sum(value: Column | str) -> Column:
    """Sum without floating-point order effects, as the DOUBLE next to the exact sum.

    Each number below 1e18 in size counts with nine decimals: its whole part and its
    billionths are cut into limbs of 15 bits, whose sums hold 2^47 rows, and the carries are
    added at the end. That needs no decimals per row. Larger numbers, infinities and NaN are
    added as doubles. NULL for an empty group.
    """
    col = as_column(value).cast("double")
    whole, billionths = ([F.sum(x) for x in part] for part in _limbs(col))
    large = F.sum(F.when(~(F.abs(col) < _EXACT), col))
    small = exact_total(whole, billionths)
    return F.when(large.isNull(), small).otherwise(large + F.coalesce(small, F.lit(0.0)))


def exact_avg(value: Column | str) -> Column:
    """Mean of the non-null numbers from an exact sum; NULL for an empty group."""
    return exact_sum(value) / F.nullif(F.count(as_column(value)), F.lit(0))


def ratio(part: Column | str, whole: Column | str) -> Column:
    """Quotient of two sums, NULL when the denominator is zero."""
    return F.sum(as_column(part).cast("double")) / F.nullif(
        F.sum(as_column(whole)).cast("double"), F.lit(0.0)
    )


def ratio_pct(part: Column | str, whole: Column | str, digits: int = 2) -> Column:
    """``ratio`` in percent, rounded."""
    return round_to(ratio(part, whole) * 100, digits)


# Text that is a number; asked before a cast, as a failing cast is far dearer than a match.
NUMBER = r"^\s*[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?\s*$"


def lenient_double(text: Column | str) -> Column:
    """Decimal text to DOUBLE; other text is NULL."""
    col = as_column(text)
    return F.when(col.rlike(NUMBER), col.try_cast("double"))


def lenient_int(text: Column | str) -> Column:
    """Text to INT through DOUBLE ("12.0" is 12); bad text and numbers out of range are NULL."""
    number = lenient_double(text)
    return F.when(number.between(-(2.0**31), 2.0**31 - 1), number.cast("int"))


# Whole numbers of at most 18 digits, which always fit a BIGINT.
WHOLE = r"^\s*[+-]?[0-9]{1,18}\s*$"
# Text that Spark takes for a truth value.
TRUTH = r"(?i)^\s*(t|true|y|yes|f|false|n|no|1|0)\s*$"


def lenient_long(text: Column | str) -> Column:
    """Text to BIGINT; integers stay exact, "12.0" goes through DOUBLE, bad text is NULL."""
    col = as_column(text)
    digits = F.regexp_extract(col, r"^\s*[+-]?([0-9]+)\s*$", 1)
    number = lenient_double(col)
    return (
        F.when(col.rlike(WHOLE), F.trim(col).cast("bigint"))
        .when(F.length(digits) == 19, F.trim(col).try_cast("bigint"))
        .when(number.between(-(2.0**63), 2.0**63 - 1024), number.cast("bigint"))
    )


def lenient_flag(text: Column | str) -> Column:
    """0/1, true/false, yes/no text to BOOLEAN; anything else is NULL."""
    col = as_column(text)
    number = lenient_double(col)
    return F.coalesce(number != 0, F.when(col.rlike(TRUTH), F.trim(col).cast("boolean")))
