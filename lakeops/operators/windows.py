"""Ordered windows per entity that also hold when one entity owns much of the table."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.numbers import round_to
from lakeops.workspace import stored

# A group above this many rows is split along its order; below it, one task sorts it whole.
MAX_GROUP_ROWS = 2_000_000
# Pieces per MAX_GROUP_ROWS, so that pieces stay small when the order is unevenly filled.
PIECES = 16
# Text is placed along its order by so many bytes at a time, and so many times.
TEXT_BYTES, TEXT_PLACES = 6, 6
# Where NULL stands among positions: it sorts first.
BEFORE_ALL = -1e300

WindowColumns = dict[str, Callable[[WindowSpec], Column]]


def over_long_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    columns: WindowColumns,
    *,
    back: int = 1,
    relevant: Column | None = None,
    sizes_from: DataFrame | None = None,
    max_rows: int = MAX_GROUP_ROWS,
) -> DataFrame:
    """Add window columns per group, splitting groups of more than ``max_rows`` rows.

    ``columns`` maps a name to a function of the ordered window. The functions may look at
    most ``back`` rows back, or, with ``relevant``, at the last relevant row and at rows
    after it. ``order`` is ascending and total; long groups are split along its leading
    columns that are numbers, dates, timestamps or text, until their pieces are short.
    Inputs of at most ``max_rows`` rows hold no longer group and are not looked into.

    Each piece of a long group gets copies of the ``back`` rows before it, so the pieces are
    computed by different tasks with the same result. ``sizes_from`` is a cheaper frame that
    has ``keys`` and ``order`` and at least as many rows per group.
    """
    sizes_from = df if sizes_from is None else sizes_from
    sizes_from = sizes_from.select(*keys, *order)
    plain = Window.partitionBy(*keys).orderBy(*order)
    short = sizes_from.count() <= max_rows  # a count of plain files reads their footers
    levels = [] if short else _levels(sizes_from, keys, order, max_rows)
    if not levels:
        return df.withColumns({name: f(plain) for name, f in columns.items()})

    pieces = _with_pieces(df, levels, keys, order)
    rows = pieces.withColumn("_copy", F.lit(False)).unionByName(
        _rows_before(pieces, df.columns, keys, order, back, relevant)
    )
    window = Window.partitionBy(*keys, "_piece").orderBy(*order)
    added = rows.withColumns({name: f(window) for name, f in columns.items()})
    return added.where(~F.col("_copy")).drop("_copy", "_piece")


def _positions(df: DataFrame, order: Sequence[str]) -> list[tuple[Column, Column]]:
    """Numbers that never decrease along the leading order columns, and the values they stand for.

    Text has a number for each few of its bytes: a piece whose texts begin alike is split
    along the bytes after that.
    """
    found = []
    for column in order:
        kind = df.select(column).schema[0].dataType
        col = F.col(column)
        if isinstance(kind, T.StringType):
            data = col.cast("binary")
            for i in range(TEXT_PLACES):
                part = F.substring(data, 1 + i * TEXT_BYTES, TEXT_BYTES)
                digits = F.rpad(F.hex(part), 2 * TEXT_BYTES, "0")
                number = F.conv(digits, 16, 10).cast("double")
                # the last number stands for all that is left of the text
                value = part if i < TEXT_PLACES - 1 else F.substring(data, 1 + i * TEXT_BYTES, 1 << 30)
                found.append((F.coalesce(number, F.lit(BEFORE_ALL)), value))
            continue
        if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            number = F.unix_micros(col.cast("timestamp"))
        elif isinstance(kind, T.DateType):
            number = F.unix_date(col)
        elif isinstance(kind, T.NumericType):
            number = col
        else:
            break
        found.append((F.coalesce(number.cast("double"), F.lit(BEFORE_ALL)), col))
    return found


def _levels(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], max_rows: int
) -> list[DataFrame]:
    """Tables of (keys, piece, low, high, ..) of pieces to split; the first has whole groups.

    A table has at most (all rows / max_rows) rows. Only rows of the pieces being split are
    read for the next table.
    """
    places = _positions(df, order)
    names = [f"_p{i}" for i in range(len(places))]
    values = [f"_v{i}" for i in range(len(names))]
    rows = df.select(
        *keys,
        *[p.alias(n) for (p, _), n in zip(places, names, strict=True)],
        *[v.alias(n) for (_, v), n in zip(places, values, strict=True)],
        F.array().cast("array<bigint>").alias("_piece"),
    )
    levels: list[DataFrame] = []
    while names:
        crowded = (
            rows.groupBy(*keys, "_piece")
            .agg(
                F.count("*").alias("_n"),
                *[F.min(n).alias(f"_low{n}") for n in names],
                *[F.max(n).alias(f"_high{n}") for n in names],
                # numbers beyond 2^53 may differ although their positions are equal
                *[F.min(v).alias(f"_low{v}") for v in values],
                *[F.max(v).alias(f"_high{v}") for v in values],
            )
            .where(F.col("_n") > max_rows)
        )
        # split along the first order column that is not the same in the whole piece
        at = F.lit(None).cast("int")
        low = high = F.lit(None).cast("double")
        for i in reversed(range(len(names))):
            first, last = F.col(f"_low_p{i}"), F.col(f"_high_p{i}")
            varies = (first < last) | F.coalesce(F.col(f"_low_v{i}") != F.col(f"_high_v{i}"), F.lit(False))
            at = F.when(varies, F.lit(i)).otherwise(at)
            low, high = F.when(varies, first).otherwise(low), F.when(varies, last).otherwise(high)
        chosen = crowded.select(
            *keys,
            "_piece",
            at.alias("_at"),
            low.alias("_low"),
            ((high - low) / (F.ceil(F.col("_n") / max_rows) * PIECES)).alias("_width"),
        ).where(F.col("_width") > 0)
        level = stored(chosen, "long-groups")
        if level.isEmpty():
            break
        levels.append(level)
        rows = _split(rows, level, keys, names, "inner")
    return levels


def _split(
    rows: DataFrame, level: DataFrame, keys: Sequence[str], positions: Sequence[str], how: str
) -> DataFrame:
    """Append the place within its piece to ``_piece`` for rows of the pieces in ``level``."""
    marks = level.select(
        *[F.col(k).alias(f"_g_{k}") for k in keys],
        F.col("_piece").alias("_g_piece"),
        "_at", "_low", "_width",
    )
    condition = F.col("_piece") == F.col("_g_piece")
    for key in keys:
        condition = condition & F.col(key).eqNullSafe(F.col(f"_g_{key}"))
    place = F.lit(None).cast("double")
    for i, name in enumerate(positions):
        place = F.when(F.col("_at") == i, F.col(name)).otherwise(place)
    step = F.floor((place - F.col("_low")) / F.col("_width")).cast("bigint")
    longer = F.when(F.col("_at").isNotNull(), F.concat("_piece", F.array(step))).otherwise(F.col("_piece"))
    return rows.join(marks, condition, how).select(
        *[c for c in rows.columns if c != "_piece"], longer.alias("_piece")
    )


def _with_pieces(
    df: DataFrame, levels: Sequence[DataFrame], keys: Sequence[str], order: Sequence[str]
) -> DataFrame:
    """Add ``_piece``: empty for short groups, else places that sort as the rows do."""
    positions = {f"_p{i}": p for i, (p, _) in enumerate(_positions(df, order))}
    rows = df.withColumns({**positions, "_piece": F.array().cast("array<bigint>")})
    for level in levels:
        rows = _split(rows, level, keys, list(positions), "left")
    return rows.drop(*positions)


def _rows_before(
    pieces: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    order: Sequence[str],
    back: int,
    relevant: Column | None,
) -> DataFrame:
    """Copies of the rows each piece of a long group must see before its own."""
    if relevant is not None and back != 1:
        raise ValueError("relevant rows are carried one at a time")
    wanted = F.lit(True) if relevant is None else F.coalesce(relevant, F.lit(False))
    last_rows = Window.partitionBy(*keys, "_piece").orderBy(
        F.col("_wanted").desc(), *[F.col(c).desc() for c in order]
    )
    # at most ``back`` rows per piece from here on
    ends = (
        pieces.where(F.size("_piece") > 0)
        .withColumn("_wanted", wanted)
        .withColumn("_rank", F.row_number().over(last_rows))
        .where(F.col("_rank") <= back)
        .groupBy(*keys, "_piece")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.when(F.col("_wanted"), F.struct((-F.col("_rank")).alias("_at"), *columns))
                )
            ).alias("_ends")
        )
    )
    in_order = Window.partitionBy(*keys).orderBy("_piece")
    if back == 1:
        filled = F.when(F.size("_ends") > 0, F.col("_ends"))
        before = F.last(filled, ignorenulls=True).over(
            in_order.rowsBetween(Window.unboundedPreceding, -1)
        )
    else:
        # every piece holds a row, so the last ``back`` pieces hold the last ``back`` rows
        listed = F.flatten(F.collect_list("_ends").over(in_order.rowsBetween(-back, -1)))
        before = F.when(F.size(listed) > back, F.slice(listed, -back, back)).otherwise(listed)
    return (
        ends.select(F.col("_piece"), before.alias("_before"))
        .select("_piece", F.explode("_before").alias("_row"))
        .select(*[F.col("_row")[c].alias(c) for c in columns], "_piece")
        .withColumn("_copy", F.lit(True))
    )


def rolling_avg(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: str,
    name: str,
    rows: int = 5,
    digits: int = 2,
    **limits,
) -> DataFrame:
    """Mean of ``value`` over the current and the ``rows - 1`` rows before it."""
    columns = {name: lambda w: round_to(F.avg(value).over(w.rowsBetween(1 - rows, 0)), digits)}
    return over_long_groups(df, keys, order, columns, back=rows - 1, **limits)


def with_previous_date(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    date: str,
    name: str = "prev_game_date",
    flag: str = "is_back_to_back",
    **limits,
) -> DataFrame:
    """Date of the row before, and whether it is exactly one day earlier (False if none)."""
    added = over_long_groups(
        df, keys, order, {name: lambda w: F.lag(date).over(w)}, back=1, **limits
    )
    return added.withColumn(
        flag, F.coalesce(F.datediff(F.col(date), F.col(name)) == 1, F.lit(False))
    )


def carry_forward(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    value: Column,
    valid: Column,
    name: str,
    default,
    **limits,
) -> DataFrame:
    """Last valid value up to and including the row, ``default`` before the first one."""
    columns = {
        name: lambda w: F.coalesce(
            F.last(F.when(valid, value), ignorenulls=True).over(
                w.rowsBetween(Window.unboundedPreceding, 0)
            ),
            F.lit(default),
        )
    }
    return over_long_groups(df, keys, order, columns, back=1, relevant=valid, **limits)


def top_per_group(df: DataFrame, group: Sequence[str], measure: str, name: str = "rnk") -> DataFrame:
    """Rows of rank 1 by ``measure`` descending; ties are all kept.

    The rank filter also runs before the shuffle, so a hot group is cut in every map task.
    """
    window = Window.partitionBy(*group).orderBy(F.col(measure).desc())
    return df.withColumn(name, F.rank().over(window).cast("long")).where(F.col(name) == 1)


def top_rows(df: DataFrame, order: Sequence[str | Column], n: int) -> DataFrame:
    """First ``n`` rows of a total order; each task keeps ``n`` rows only."""
    return df.orderBy(*order).limit(n)
