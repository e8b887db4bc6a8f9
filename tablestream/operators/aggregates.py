"""Grouped and long-format statistics."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tablestream.functions.columns import money, total_money, unit_of
from tablestream.functions.predicates import date_range, last

METRICS = ["temperature", "humidity", "pressure", "wind_speed"]


def group_average(df: DataFrame, key: str, value: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.avg(value).alias(name))


def filtered_total(df: DataFrame, amount: str, min_amount: float, name: str) -> DataFrame:
    """Sum of the amounts above a limit; 0 when there is none."""
    total = F.coalesce(total_money(F.col(amount)), F.lit(0.0))
    return df.filter(F.col(amount) > min_amount).agg(total.alias(name))


def revenue_by_salesperson(df: DataFrame) -> DataFrame:
    return df.groupBy("Salesperson").agg(
        F.count("Lead Name").alias("total_leads"),
        total_money(F.col("Forecasted Monthly Revenue")).alias("total_revenue"),
    )


def leads_by_region(df: DataFrame) -> DataFrame:
    return df.groupBy("Region").agg(
        F.count(F.lit(1)).alias("total_leads"),
        total_money(F.col("Forecasted Monthly Revenue")).alias("total_revenue"),
    )


def monthly_revenue(df: DataFrame) -> DataFrame:
    return df.groupBy(F.trunc("Date", "month").alias("month")).agg(
        total_money(F.col("Forecasted Monthly Revenue")).alias("total_revenue"),
        F.count(F.lit(1)).alias("num_opportunities"),
    )


def strong_months(df: DataFrame, day: str, amount: str) -> DataFrame:
    """Revenue by year and month, for the months at or above the mean month."""
    months = df.groupBy(F.year(day).alias("year"), F.month(day).alias("month")).agg(
        F.sum(money(F.col(amount))).alias("revenue")
    )
    # One row a month: the mean over all of them is a window over a calendar, in the same pass.
    months = months.withColumn("_mean", F.avg("revenue").over(Window.partitionBy()))
    return months.filter(F.col("revenue") >= F.col("_mean")).select(
        "year", "month", F.col("revenue").cast("double").alias("monthly_revenue")
    )


def daily_summary(df: DataFrame, as_of, days: int = 30) -> DataFrame:
    """Weather per city and day over the last ``days`` days."""
    recent = last(df, "measurement_time", days, "DAYS", as_of)
    return recent.groupBy("city_name", F.to_date("measurement_time").alias("date")).agg(
        F.avg("temperature").alias("avg_temp"),
        F.max("temperature").alias("max_temp"),
        F.min("temperature").alias("min_temp"),
        F.avg("humidity").alias("avg_humidity"),
        F.avg("pressure").alias("avg_pressure"),
        F.avg("wind_speed").alias("avg_wind_speed"),
        F.count(F.lit(1)).alias("measurement_count"),
    )


def _long_stats(df: DataFrame, group: list, sources: dict[str, tuple[str, str, str]]) -> DataFrame:
    """Statistics of several metrics in one pass: all metrics side by side in one aggregate, and
    only its few rows are turned long."""
    wide = []
    for metric, (mean, low, high) in sources.items():
        wide.append(
            F.struct(
                F.lit(metric).alias("metric_type"),
                F.avg(mean).alias("avg_value"),
                F.min(low).alias("min_value"),
                F.max(high).alias("max_value"),
                F.stddev(mean).alias("std_dev"),
            ).alias(f"_{metric}")
        )
    grouped = df.groupBy(*group).agg(*wide)
    names = [name for name in grouped.columns if name not in [f"_{m}" for m in sources]]
    entries = F.array(*[F.col(f"_{metric}") for metric in sources])
    return grouped.select(*names, F.explode(entries).alias("_stat")).select(*names, "_stat.*")


def metric_stats(df: DataFrame, key: str, ts: str, metrics: list[str] = METRICS) -> DataFrame:
    """One row per key, day and metric with mean, minimum, maximum and sample deviation."""
    day = F.to_date(ts).alias("date")
    return _long_stats(df, [F.col(key), day], {m: (m, m, m) for m in metrics})


def with_units(stats: DataFrame) -> DataFrame:
    return stats.withColumn("unit", unit_of(F.col("metric_type")))


def hourly_metric_stats(hourly: DataFrame) -> DataFrame:
    """Daily statistics over rows that are hourly statistics already."""
    sources = {
        "temperature": ("avg_temperature", "min_temperature", "max_temperature"),
        "humidity": ("avg_humidity",) * 3,
        "pressure": ("avg_pressure",) * 3,
    }
    group = [F.col("city_name"), F.to_date("window_start").alias("date")]
    return _long_stats(hourly, group, sources)


def stats(
    df: DataFrame,
    metric: str,
    ts: str,
    city: str | None = None,
    start=None,
    end=None,
    prefix: str = "",
) -> DataFrame:
    """Daily statistics of one metric. ``prefix`` is ``avg_`` for an hourly table, which has no
    wind: its wind statistics are NULL."""
    if metric not in METRICS:
        raise ValueError(f"unknown metric: {metric}")
    rows = date_range(df, ts, start, end)
    if city is not None:
        rows = rows.filter(F.col("city_name") == city)
    column = prefix + metric
    value = F.col(column) if column in df.columns else F.lit(None).cast("double")
    return (
        rows.groupBy("city_name", F.to_date(ts).alias("date"))
        .agg(
            F.avg(value).alias("avg_value"),
            F.min(value).alias("min_value"),
            F.max(value).alias("max_value"),
            F.stddev(value).alias("std_dev"),
        )
        .withColumn("metric", F.lit(metric))
    )


def key_comparison(df: DataFrame, as_of, days: int = 7) -> DataFrame:
    """Mean of every metric per city over the last days, side by side."""
    recent = last(df, "measurement_time", days, "DAYS", as_of)
    return recent.groupBy("city_name").agg(*[F.avg(m).alias(f"avg_{m}") for m in METRICS])


def key_comparison_pivot(daily_stats: DataFrame, as_of, days: int = 7) -> DataFrame:
    """The same from the long table of daily means: means of means, one column per metric."""
    recent = last(daily_stats, "date", days, "DAYS", as_of)
    wide = recent.groupBy("city_name").pivot("metric_type", METRICS).agg(F.avg("avg_value"))
    return wide.withColumnsRenamed({m: f"avg_{m}" for m in METRICS})


def availability(df: DataFrame, key: str, day: str, as_of: date, days: int) -> DataFrame:
    """Record counts per (day, key), per day, per key and overall, for exactly ``days`` days up to
    ``as_of``. ``level`` is 0 for a pair, 1 for a day, 2 for a key, 3 for the total."""
    start = as_of - timedelta(days=days - 1)
    pairs = (
        df.filter(F.col(day).between(F.lit(start), F.lit(as_of)))
        .groupBy(F.col(day).alias("date"), key)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # Grouping sets copy each row four times, so they run on the counted pairs.
    return pairs.cube("date", key).agg(
        F.sum("n").alias("record_count"), F.grouping_id().cast("int").alias("level")
    )


def partition_rows(df: DataFrame, column: str, day) -> DataFrame:
    wanted = F.lit(str(day)).cast("date")
    return df.filter(F.col(column) == wanted).agg(F.count(F.lit(1)).alias("rows"))


def click_rollup(clicks: DataFrame) -> DataFrame:
    """Clicks and their mean duration by event type and country."""
    return clicks.groupBy("event_type", "country").agg(
        F.sum("count").alias("clicks"), F.avg("avg_duration").alias("avg_duration")
    )


def version_counts(df: DataFrame, version: str = "schema_version") -> DataFrame:
    return df.groupBy(version).agg(F.count(F.lit(1)).alias("records"))


def metric_series(stats_table: DataFrame, metric: str) -> DataFrame:
    return stats_table.filter(F.col("metric_type") == metric).select(
        "city_name", "date", "avg_value"
    )


def metric_matrix(stats_table: DataFrame, metric: str, cities: list[str]) -> DataFrame:
    """Days down, the named cities across."""
    rows = stats_table.filter(F.col("metric_type") == metric)
    return rows.groupBy("date").pivot("city_name", cities).agg(F.avg("avg_value"))


def metric_profile(stats_table: DataFrame) -> DataFrame:
    """Statistics per city and metric over the long table of daily statistics."""
    return stats_table.groupBy("city_name", "metric_type").agg(
        F.avg("avg_value").alias("avg_value"),
        F.min("min_value").alias("min_value"),
        F.max("max_value").alias("max_value"),
        F.avg("std_dev").alias("std_dev"),
    )


def profile_of(stats_table: DataFrame, metric: str) -> DataFrame:
    """Mean of one metric per city."""
    rows = stats_table.filter(F.col("metric_type") == metric)
    return rows.groupBy("city_name").agg(F.avg("avg_value").alias("avg_value"))


def newest_window(df: DataFrame, start: str = "window_start") -> DataFrame:
    """Rows of the newest window in the table."""
    return df.filter(F.col(start) == df.agg(F.max(start)).scalar())


def recent_windows(df: DataFrame, as_of, hours: int = 3) -> DataFrame:
    """Windows of the last hours, with the window struct laid out as two columns."""
    flat = df
    if "window" in df.columns:
        flat = df.select(
            *[c for c in df.columns if c != "window"],
            F.col("window.start").alias("window_start"),
            F.col("window.end").alias("window_end"),
        )
    return last(flat, "window_start", hours, "HOURS", as_of)


def of_day(df: DataFrame, column: str, day) -> DataFrame:
    return df.filter(F.col(column) == F.lit(str(day)).cast("date"))


