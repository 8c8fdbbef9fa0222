"""Text, id, name and JSON helpers as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeops.functions.numbers import as_column, lenient_long


def normalize_id(text: Column | str) -> Column:
    """Id text without a decimal part: "204001.0" is "204001"; other text stays, NULL is ""."""
    col = as_column(text)
    return F.coalesce(lenient_long(col).cast("string"), col, F.lit(""))


def first_token(name: Column | str) -> Column:
    """Text before the first blank."""
    return F.trim(F.split_part(as_column(name), F.lit(" "), F.lit(1)))


def after_first_token(name: Column | str) -> Column:
    """Text after the first token; a single token is returned unchanged."""
    return F.trim(F.regexp_replace(as_column(name), r"^\S+\s+", ""))


def name_key(*parts: Column | str) -> Column:
    """Trimmed lower-case name used for comparing; NULL when a part is NULL."""
    cleaned = [F.lower(F.trim(as_column(p))) for p in parts]
    joined = [cleaned[0]]
    for part in cleaned[1:]:
        joined += [F.lit(" "), part]
    return F.concat(*joined)


def is_digits(text: Column | str) -> Column:
    """True for non-empty text of decimal digits only."""
    return as_column(text).cast("string").rlike("^[0-9]+$")


def contains_flag(text: Column | str, part: str) -> Column:
    """1 when the text contains ``part``, else 0, also for NULL."""
    return F.when(as_column(text).contains(part), 1).otherwise(0)


def equals_flag(text: Column | str, value: str) -> Column:
    """1 when the text equals ``value``, else 0, also for NULL."""
    return F.when(as_column(text) == value, 1).otherwise(0)


def typed_defaults(df: DataFrame, skip: tuple[str, ...] = ()) -> DataFrame:
    """NULL numbers become 0 and NULL strings become ""; other types stay."""
    filled = {}
    for field in df.schema.fields:
        if field.name in skip:
            continue
        if isinstance(field.dataType, T.NumericType):
            filled[field.name] = F.coalesce(F.col(field.name), F.lit(0).cast(field.dataType))
        elif isinstance(field.dataType, T.StringType):
            filled[field.name] = F.coalesce(F.col(field.name), F.lit(""))
    return df.withColumns(filled)


# Timestamps in messages, with microseconds.
MESSAGE_FORMATS = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][XXX]",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
}


def parse_json(
    df: DataFrame, schema: T.StructType, column: str = "value", corrupt: str | None = None
) -> DataFrame:
    """Expand JSON text (or bytes) to typed columns.

    Broken text gives a row of NULLs and a bad field gives NULL for that field. With
    ``corrupt`` the text of rows that could not be read is kept in that column.
    """
    wanted = schema
    options = {"mode": "PERMISSIVE", **MESSAGE_FORMATS}
    if corrupt:
        wanted = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
        options["columnNameOfCorruptRecord"] = corrupt
    parsed = F.from_json(F.col(column).cast("string"), wanted, options)
    return df.select(parsed.alias("data")).select("data.*")


def to_messages(df: DataFrame, key: str | None = None, value: str = "value") -> DataFrame:
    """Rows as JSON text messages, with an optional text key."""
    columns = [F.to_json(F.struct("*"), {"ignoreNullFields": "false", **MESSAGE_FORMATS}).alias(value)]
    if key:
        columns.insert(0, F.col(key).cast("string").alias("key"))
    return df.select(*columns)
