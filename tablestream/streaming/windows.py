"""Windowed aggregates; the same functions run on batch tables and on streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOURLY_WATERMARK = "10 minutes"


def _flat(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"window_start": F.col("window.start"), "window_end": F.col("window.end")}
    ).drop("window")


def hourly_readings(df: DataFrame, key: str, ts: str, lateness: str = HOURLY_WATERMARK):
    """Six statistics per key and event-time hour. Rows later than the watermark are dropped."""
    return _flat(
        df.withWatermark(ts, lateness)
        .groupBy(key, F.window(ts, "1 hour"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("pressure").alias("avg_pressure"),
            F.avg("wind_speed").alias("avg_wind_speed"),
        )
    )


def arrival_hours(df: DataFrame, key: str, arrival: str = "arrival", delay: str = "0 seconds"):
    """Statistics per key and hour of arrival. Missing values are left out metric by metric; an
    hour without any temperature gives no row."""
    return _flat(
        df.withWatermark(arrival, delay)
        .groupBy(key, F.window(arrival, "1 hour"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("pressure").alias("avg_pressure"),
        )
        .filter(F.col("avg_temperature").isNotNull())
    )


def minute_counts(df: DataFrame, key: str, ts: str, lateness: str = "60 seconds"):
    """Events per key and minute; the state of a minute is dropped one minute after its end."""
    return _flat(
        df.withWatermark(ts, lateness)
        .groupBy(key, F.window(ts, "60 seconds"))
        .agg(F.count(F.lit(1)).alias("events"))
    )


def running_counts(df: DataFrame, key: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("events"))


def throughput(df: DataFrame, ts: str, seconds: int = 5) -> DataFrame:
    """Events per second in bins of a few seconds; empty bins are left out."""
    bins = df.groupBy(F.window(ts, f"{seconds} seconds")).agg(F.count(F.lit(1)).alias("_n"))
    return bins.select(
        F.col("window.start").alias("bin_start"), (F.col("_n") / seconds).alias("events_per_second")
    )


def recent_events(df: DataFrame, ts: str, as_of: Column, seconds: int = 60) -> DataFrame:
    since = as_of - F.make_dt_interval(secs=F.lit(seconds))
    return df.filter(F.col(ts) >= since).agg(F.count(F.lit(1)).alias("events"))
