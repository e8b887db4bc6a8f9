"""Daily series: moving averages, trends and the seasonal forecast."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.functions.predicates import mentions_rain

TREND_SLOPE = 0.1


def daily_mean(df: DataFrame, key: str, ts: str, metric: str) -> DataFrame:
    return df.groupBy(key, F.to_date(ts).alias("date")).agg(F.avg(metric).alias("value"))


def moving_average(
    df: DataFrame, keys: list[str], day: str, value: str, name: str, days: int = 7
) -> DataFrame:
    """Mean of the last ``days`` daily rows. Groups are daily rows, so they stay short."""
    frame = Window.partitionBy(*keys).orderBy(day).rowsBetween(-(days - 1), 0)
    return df.withColumn(name, F.avg(value).over(frame))


def week_over_week(df: DataFrame, key: str, day: str, value: str) -> DataFrame:
    """Last seven rows against the seven before; 'stable' while there are none before."""
    ordered = Window.partitionBy(key).orderBy(day)
    this_week = F.avg(value).over(ordered.rowsBetween(-6, 0))
    week_before = F.avg(value).over(ordered.rowsBetween(-13, -7))
    both = df.withColumns({"moving_avg": this_week, "previous_avg": week_before})
    label = (
        F.when(F.col("moving_avg") > F.col("previous_avg"), "increasing")
        .when(F.col("moving_avg") < F.col("previous_avg"), "decreasing")
        .otherwise("stable")
    )
    return both.withColumn("trend", label)


def _direction(slope: Column, limit: float) -> Column:
    return (
        F.when(slope > limit, "increasing").when(slope < -limit, "decreasing").otherwise("stable")
    )


def _recent_daily(df, key, ts, metric, days, as_of):
    start, end = as_of - timedelta(days=days), as_of + timedelta(days=1)
    kind = df.schema[ts].dataType
    rows = df.filter(
        (F.col(ts) >= F.lit(str(start)).cast(kind)) & (F.col(ts) < F.lit(str(end)).cast(kind))
    )
    daily = daily_mean(rows, key, ts, metric)
    # Days counted from the start of the range: large day numbers would cost precision.
    return daily.withColumn("_x", F.datediff("date", F.lit(start)))


def trend(
    df: DataFrame, key: str, ts: str, metric: str, days: int, as_of: date,
    limit: float = TREND_SLOPE,
) -> DataFrame:
    """Per key: slope of the daily means in units per day, its label, and the points as an array
    ordered by date. A single point has no slope and is 'stable'."""
    daily = _recent_daily(df, key, ts, metric, days, as_of)
    points = F.sort_array(F.collect_list(F.struct("date", "value")))
    return (
        daily.groupBy(key)
        .agg(F.regr_slope("value", "_x").alias("change_rate"), points.alias("data_points"))
        .withColumn("trend_direction", _direction(F.col("change_rate"), limit))
        .withColumn("metric", F.lit(metric))
    )


def trend_series(
    df: DataFrame, key: str, ts: str, metric: str, days: int, as_of: date,
    limit: float = TREND_SLOPE,
) -> DataFrame:
    """Every daily point with the slope and label of its key."""
    daily = _recent_daily(df, key, ts, metric, days, as_of)
    slope = F.regr_slope("value", "_x").over(Window.partitionBy(key))
    sloped = daily.withColumn("change_rate", slope).drop("_x")
    return sloped.withColumn("trend_direction", _direction(F.col("change_rate"), limit))


def seasonal_forecast(
    df: DataFrame,
    key: str,
    ts: str,
    temperature: str,
    humidity: str,
    condition: str,
    as_of: date,
    days: int,
    season: int = 365,
) -> DataFrame:
    """Forecast for each of the next ``days`` days from the same day one season earlier.

    The commonest condition wins, the alphabetically first of equals. A key without history has
    no rows.
    """
    first = as_of + timedelta(days=1 - season)
    end = first + timedelta(days=days)
    kind = df.schema[ts].dataType
    history = df.filter(
        (F.col(ts) >= F.lit(str(first)).cast(kind)) & (F.col(ts) < F.lit(str(end)).cast(kind))
    )
    # Per condition first: few rows per day are left to choose the commonest from.
    by_condition = history.groupBy(
        key, F.to_date(ts).alias("_day"), F.col(condition).alias("_c")
    ).agg(
        F.min(temperature).alias("_min"),
        F.max(temperature).alias("_max"),
        F.sum(temperature).alias("_sum"),
        F.count(temperature).alias("_count"),
        F.sum(humidity).alias("_hsum"),
        F.count(humidity).alias("_hcount"),
        F.count(F.lit(1)).alias("_n"),
    )
    rainy = F.sum(F.when(mentions_rain(F.col("_c")), F.col("_n")).otherwise(0))
    return (
        by_condition.groupBy(key, "_day")
        .agg(
            F.min("_min").alias("temperature_min"),
            F.max("_max").alias("temperature_max"),
            F.try_divide(F.sum("_sum"), F.sum("_count")).alias("temperature_avg"),
            F.try_divide(F.sum("_hsum"), F.sum("_hcount")).alias("humidity"),
            F.min_by(
                "_c", F.when(F.col("_c").isNotNull(), F.struct(-F.col("_n"), F.col("_c")))
            ).alias("weather_condition"),
            (rainy / F.sum("_n") * 100).alias("precipitation_probability"),
        )
        .withColumn("forecast_date", F.date_add("_day", season))
        .drop("_day")
    )
