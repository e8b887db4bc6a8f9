"""The weather tables end to end: daily jobs, dashboard views and filtered reads.

Each read takes the best table there is and hands its rows, in common columns, to the operators.
``as_of`` stands for the present.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions.predicates import date_range, last
from tablestream.operators import aggregates, alerts, ranking, series, shape
from tablestream.schemas import RAW_WEATHER
from tablestream.sources.readers import (
    ANALYTICS_TABLES,
    DETAIL_TABLES,
    read_landing,
    resolve_table,
)
from tablestream.sources.writers import counted, create_layout, load_table, replace_partition

BATCH, STREAMING = "weather_batch", "weather_streaming"
HOURLY, ANALYTICS = "weather_streaming_hourly", "weather_analytics"

# Order in which tables feed the dashboard views.
SUMMARY_TABLES = [ANALYTICS, HOURLY, STREAMING, BATCH]
LATEST_TABLES = [STREAMING, BATCH]

_LAYOUT = {BATCH: "batch", STREAMING: "streaming", HOURLY: "hourly"}
_TIME = {BATCH: "measurement_time", STREAMING: "timestamp", HOURLY: "window_start"}
_VIEW_METRICS = ["temperature", "humidity", "pressure"]


def load_weather_day(
    spark: SparkSession, root: str, day: str, processing_time=None, schema=RAW_WEATHER
) -> int:
    """One day of raw records into the batch table; returns the rows written."""
    raw = read_landing(spark, root, day, schema)
    flat = shape.flatten_weather(raw, day, processing_time)
    return load_table(
        flat, {"BATCH": BATCH}, "BATCH", partition=["processing_date"], cluster=["city_name"]
    )


def generate_analytics(spark: SparkSession, day: date, processing_time) -> int:
    """The day's statistics of all four metrics into the analytics table, in place of what it has
    for that day; returns the rows written."""
    source = resolve_table(spark, [BATCH, STREAMING])
    rows = spark.table(source)
    if source == BATCH:
        rows = rows.filter(F.col("processing_date") == F.lit(day))
        rows = rows.withColumn("_time", F.col("processing_date").cast("timestamp"))
    else:
        rows = date_range(rows, "timestamp", day, day).withColumn("_time", F.col("timestamp"))
    stats = aggregates.metric_stats(rows, "city_name", "_time").withColumn(
        "processing_time", F.lit(str(processing_time)).cast("timestamp")
    )
    written, seen = counted(stats)
    if not spark.catalog.tableExists(ANALYTICS):
        create_layout(written, ANALYTICS, ["date"], ["city_name", "metric_type"])
    else:
        replace_partition(written, ANALYTICS, "date", day)
    return seen.get["rows"]


def _detail(spark: SparkSession, whole_seconds: bool = True) -> DataFrame:
    name = resolve_table(spark, DETAIL_TABLES)
    return shape.unify_readings(spark.table(name), _LAYOUT[name], whole_seconds)


def _of_city(df: DataFrame, city: str | None) -> DataFrame:
    return df if city is None else df.filter(F.col("city_name") == city)


def weather_data(spark: SparkSession, start, end, city: str | None = None, limit: int = 100):
    """The newest readings of a range of days."""
    rows = _of_city(date_range(_detail(spark), "measurement_date", start, end), city)
    rest = [F.asc(name) for name in rows.columns if name != "measurement_time"]
    return ranking.top_n(rows, [F.desc("measurement_time"), *rest], limit)


def weather_stats(spark: SparkSession, metric: str, start, end, city: str | None = None):
    """Daily statistics of one metric."""
    if metric not in aggregates.METRICS:
        raise ValueError(f"unknown metric: {metric}")
    name = resolve_table(spark, ANALYTICS_TABLES)
    table = spark.table(name)
    if name == ANALYTICS:
        rows = table.filter(F.col("metric_type") == metric)
        days = _of_city(date_range(rows, "date", start, end), city).select(
            "city_name", "date", "avg_value", "min_value", "max_value", "std_dev",
            F.col("metric_type").alias("metric"),
        )
    else:
        prefix = "avg_" if name == HOURLY else ""
        days = aggregates.stats(table, metric, _TIME[name], city, start, end, prefix)
    return days.orderBy("city_name", "date")


def weather_trend(
    spark: SparkSession, metric: str, days: int, as_of: date, city: str | None = None
):
    """Direction, slope and daily points of one metric per city."""
    if metric not in aggregates.METRICS:
        raise ValueError(f"unknown metric: {metric}")
    name = resolve_table(spark, ANALYTICS_TABLES)
    rows = _of_city(spark.table(name), city)
    if name == ANALYTICS:
        time, value = F.col("date").cast("timestamp"), F.col("avg_value")
        rows = rows.filter(F.col("metric_type") == metric)
    else:
        column = f"avg_{metric}" if name == HOURLY else metric
        time = F.col(_TIME[name])
        value = F.col(column) if column in rows.columns else F.lit(None).cast("double")
    rows = rows.select("city_name", time.alias("t"), value.alias(metric))
    return series.trend(rows, "city_name", "t", metric, days, as_of)


def weather_alerts(spark: SparkSession, hours: int, as_of: datetime, city: str | None = None):
    """Alerts of the last hours, newest first."""
    rows = _of_city(_detail(spark, whole_seconds=False), city)
    moment = F.lit(str(as_of)).cast(rows.schema["measurement_time"].dataType)
    rows = last(rows, "measurement_time", hours, "HOURS", as_of).filter(
        F.col("measurement_time") <= moment
    )
    return (
        alerts.first_alert(rows)
        .select(
            "city_name", "alert_type", "alert_level", "message", "value", "threshold",
            F.col("measurement_time").alias("timestamp"),
        )
        .orderBy(F.desc("timestamp"), "city_name")
    )


def weather_forecast(spark: SparkSession, days: int, as_of: date, city: str | None = None):
    """The same days one season earlier as the forecast of the next ones."""
    rows = _of_city(_detail(spark, whole_seconds=False), city)
    ahead = series.seasonal_forecast(
        rows, "city_name", "measurement_time", "temperature", "humidity", "weather_condition",
        as_of, days,
    )
    return ahead.orderBy("city_name", "forecast_date")


def latest_weather(spark: SparkSession) -> DataFrame:
    name = resolve_table(spark, LATEST_TABLES)
    rows = shape.unify_readings(spark.table(name), _LAYOUT[name], whole_seconds=False)
    rows = rows.drop("measurement_date")
    tie = F.struct(*[c for c in rows.columns if c not in ("city_name", "measurement_time")])
    newest = ranking.newest_per_key(
        rows.withColumn("_tie", tie), ["city_name"], "measurement_time", "_tie"
    )
    return newest.drop("_tie")


def daily_summary(spark: SparkSession) -> DataFrame:
    """Long daily statistics from the cheapest table."""
    name = resolve_table(spark, SUMMARY_TABLES)
    table = spark.table(name)
    if name == ANALYTICS:
        return table.drop("processing_time")
    if name == HOURLY:
        return aggregates.hourly_metric_stats(table)
    return aggregates.metric_stats(table, "city_name", _TIME[name], _VIEW_METRICS)


def city_comparison(spark: SparkSession, as_of) -> DataFrame:
    name = resolve_table(spark, SUMMARY_TABLES)
    if name == ANALYTICS:
        return aggregates.key_comparison_pivot(spark.table(name), as_of)
    rows = shape.unify_readings(spark.table(name), _LAYOUT[name], whole_seconds=False)
    return aggregates.key_comparison(rows, as_of)


def weather_trends(spark: SparkSession) -> DataFrame:
    """Daily means with their unit and seven-day moving average."""
    days = daily_summary(spark).select("city_name", "date", "metric_type", "avg_value")
    moving = series.moving_average(
        aggregates.with_units(days), ["city_name", "metric_type"], "date", "avg_value",
        "moving_avg_7day",
    )
    return moving.orderBy("city_name", "metric_type", "date")


def current_weather(batch: DataFrame, as_of: date, tie: str) -> DataFrame:
    """Today's readings with their rank, newest first."""
    today = date_range(batch, "measurement_time", as_of, as_of)
    return ranking.rank_newest(today, "city_name", "measurement_time", tie)


def create_report_views(spark: SparkSession, as_of: datetime) -> list[str]:
    """Register the five report views over the batch and the hourly table, each a plan that runs
    when it is read; returns the names of those whose table exists."""

    def current() -> DataFrame:
        today = date_range(spark.table(BATCH), "measurement_time", as_of.date(), as_of.date())
        return ranking.rank_by_period(today, "city_name", "measurement_time")

    def daily() -> DataFrame:
        return aggregates.daily_summary(spark.table(BATCH), as_of.date(), 30)

    def trends() -> DataFrame:
        means = ["avg_temp", "avg_humidity", "avg_pressure", "avg_wind_speed"]
        days = daily().select("city_name", "date", *means)
        weeks = series.week_over_week(days, "city_name", "date", "avg_temp")
        return weeks.select(
            "city_name", "date", *means, F.col("moving_avg").alias("temp_7day_moving_avg"),
            F.col("trend").alias("temp_trend"),
        )

    def warned() -> DataFrame:
        recent = last(spark.table(BATCH), "measurement_time", 24, "HOURS", as_of)
        found = alerts.first_alert(recent, critical=alerts.VIEW_LEVELS)
        return found.select(
            "city_name", "alert_type", "alert_level", "temperature", "humidity", "wind_speed",
            "pressure", "measurement_time",
        )

    def realtime() -> DataFrame:
        return aggregates.recent_windows(spark.table(HOURLY), as_of, 3)

    views = {
        "current_weather_view": (BATCH, current),
        "daily_weather_view": (BATCH, daily),
        "weather_trends_view": (BATCH, trends),
        "weather_alerts_view": (BATCH, warned),
        "realtime_weather_view": (HOURLY, realtime),
    }
    made = []
    for name, (table, build) in views.items():
        if spark.catalog.tableExists(table):
            build().createOrReplaceTempView(name)
            made.append(name)
    return made


def create_views(spark: SparkSession, as_of) -> list[str]:
    """Register the dashboard views for which a table exists; returns their names."""
    views = {
        "latest_weather": lambda: latest_weather(spark),
        "daily_summary": lambda: daily_summary(spark),
        "city_comparison": lambda: city_comparison(spark, as_of),
        "weather_trends": lambda: weather_trends(spark),
    }
    made = []
    for name, build in views.items():
        try:
            view = build()
        except ValueError:
            continue
        view.createOrReplaceTempView(name)
        made.append(name)
    return made
