"""Scalar expressions shared by batch and streaming code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Unit of measure per metric.
UNITS = {"temperature": "°C", "humidity": "%", "pressure": "hPa", "wind_speed": "m/s"}


def cents_to_units(cents: Column) -> Column:
    return cents / F.lit(100.0)


def unit_of(metric: Column) -> Column:
    """Unit of a metric name, empty for an unknown one."""
    unit = F.lit("")
    for name, text in UNITS.items():
        unit = F.when(metric == name, text).otherwise(unit)
    return unit


def from_epoch(seconds: Column) -> Column:
    """Epoch seconds, possibly fractional, to a timestamp."""
    return F.timestamp_seconds(seconds)


def day_length_hours(sunrise: Column, sunset: Column) -> Column:
    return (F.unix_timestamp(sunset) - F.unix_timestamp(sunrise)) / 3600


def json_number(text: Column, path: str) -> Column:
    """Number at a JSON path of a text column; NULL where it is absent or not a number."""
    return F.get_json_object(text, path).try_cast("double")


def money(amount: Column) -> Column:
    """Exact two-digit amount, to be summed without rounding drift."""
    return amount.cast("decimal(18,2)")


def total_money(amount: Column) -> Column:
    return F.sum(money(amount)).cast("double")


def timestamp_of(text: Column) -> Column:
    """A timestamp from its message encodings: epoch seconds or ISO text."""
    number = text.try_cast("double")
    return F.when(number.isNotNull(), F.timestamp_seconds(number)).otherwise(
        text.try_cast("timestamp")
    )


def slug(name: Column) -> Column:
    return F.replace(F.lower(name), F.lit(" "), F.lit("_"))
