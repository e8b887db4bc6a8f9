"""Row filters."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UNITS = ("HOURS", "DAYS")


def _moment(df: DataFrame, column: str, value: str | date | datetime) -> Column:
    """A literal of the column's own type, so that the comparison reaches the file scan."""
    return F.lit(str(value)).cast(df.schema[column].dataType)


def _has_time(value: str | date | datetime) -> bool:
    return isinstance(value, datetime) or (isinstance(value, str) and ":" in value)


def above(df: DataFrame, column: str, limit: float) -> DataFrame:
    return df.filter(F.col(column) > limit)


def equal_to(df: DataFrame, column: str, value) -> DataFrame:
    return df.filter(F.col(column) == value)


def present(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNotNull())


def not_in(df: DataFrame, column: str, values: list) -> DataFrame:
    """Rows whose value is outside the list; NULL is neither in nor out and is left out."""
    return df.filter(~F.col(column).isin(values))


def date_range(df: DataFrame, column: str, start=None, end=None) -> DataFrame:
    """Both bounds are inclusive and optional.

    On a timestamp column an end without a time of day includes the whole day, one with a time ends
    there; the filter stays on the bare column.
    """
    if start is not None:
        df = df.filter(F.col(column) >= _moment(df, column, start))
    if end is not None:
        if df.schema[column].dataType.typeName() == "date" or _has_time(end):
            df = df.filter(F.col(column) <= _moment(df, column, end))
        else:
            limit = _moment(df, column, end) + F.expr("INTERVAL 1 DAY")
            df = df.filter(F.col(column) < limit)
    return df


def last(df: DataFrame, column: str, n: int, unit: str, as_of) -> DataFrame:
    """Rows of the last ``n`` hours or days before ``as_of``."""
    if unit.upper() not in _UNITS:
        raise ValueError(f"unit must be one of {_UNITS}")
    bound = _moment(df, column, as_of) - F.expr(f"INTERVAL {int(n)} {unit.upper()}")
    return df.filter(F.col(column) >= bound.cast(df.schema[column].dataType))


def mentions_rain(condition: Column) -> Column:
    text = F.lower(condition)
    return text.contains("rain") | text.contains("shower")
