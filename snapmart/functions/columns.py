"""Expressions built only from Spark's own functions, so they stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def is_missing(df: DataFrame, name: str) -> Column:
    """Null, zero, empty text and empty collections count as missing; NaN does not."""
    kind, col = df.schema[name].dataType, F.col(name)
    if isinstance(kind, T.NumericType):
        empty = col == 0
    elif isinstance(kind, T.StringType):
        empty = col == ""
    elif isinstance(kind, T.BooleanType):
        empty = ~col
    elif isinstance(kind, (T.ArrayType, T.MapType)):
        empty = F.size(col) == 0
    else:
        return col.isNull()
    return col.isNull() | empty


def safe_long(col: Column) -> Column:
    """Whole number or null: '12' and ' 12 ' parse, '12.7', 'all' and '' do not."""
    return col.try_cast("bigint")


def whole_number(col: Column) -> Column:
    """Like ``safe_long``, but '2015.0' is a whole number too; '2015.5' is none."""
    number = col.try_cast("double")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 2**53), number)
    return F.coalesce(safe_long(col), whole.try_cast("bigint"))


def as_double(col: Column) -> Column:
    return col.try_cast("double")


def to_stamp(col: Column) -> Column:
    """Timestamp without zone from ISO text, null where the text is no timestamp."""
    return F.try_to_timestamp(col.cast("string")).cast("timestamp_ntz")


def boundary_diff(unit: str, start: Column, end: Column) -> Column:
    """How many unit boundaries lie between two times: 00:00:59 to 00:01:01 is one minute."""
    return F.timestamp_diff(
        unit.upper(), F.date_trunc(unit, start), F.date_trunc(unit, end)
    ).cast("bigint")


def week_start(day: Column) -> Column:
    """Monday of the week as a date."""
    return F.date_trunc("week", day).cast("date")


def coalesce_names(df: DataFrame, names: Sequence[str]) -> Column:
    """First non-null of the columns that exist; null if none of them does."""
    present = [F.col(n) for n in names if n in df.columns]
    return F.coalesce(*present) if present else F.lit(None)


def first_order(*names: str) -> list[Column]:
    return [F.col(n).asc_nulls_last() for n in names]


def latest_order(*names: str) -> list[Column]:
    return [F.col(n).desc_nulls_last() for n in names]
