"""The filtered reads and dashboard views over the weather tables, here views over the events."""

from __future__ import annotations

from datetime import date, datetime
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream import weather
from tablestream.operators import aggregates, ranking
from tablestream.plans.fixtures import plain, readings, rounded, text
from tablestream.plans.registry import query
from tablestream.plans.weather import LONG_STATS, READINGS
from tablestream.sources.readers import named_views

CONDITION = """CASE event_id % 4 WHEN 0 THEN 'Light Rain' WHEN 1 THEN 'Clouds'
                    WHEN 2 THEN 'Clear' ELSE 'shower rain' END"""

BATCH = f"{READINGS}, batch AS (SELECT *, {CONDITION} AS weather_condition FROM readings)"


VIEWS = [
    "latest_weather", "daily_summary", "city_comparison", "weather_trends", "current_weather_view",
    "daily_weather_view", "weather_trends_view", "weather_alerts_view", "realtime_weather_view",
]


def _on_tables(run):
    """Run a query on the detail table and the long daily statistics, which every read prefers, as
    views that are gone afterwards."""

    @wraps(run)
    def on_tables(spark: SparkSession, data: str) -> DataFrame:
        batch = readings(spark, data).withColumns(
            {
                "weather_condition": F.expr(CONDITION),
                "processing_date": F.to_date("measurement_time"),
            }
        )
        stats = aggregates.metric_stats(batch, "city_name", "measurement_time")
        with named_views(spark, {weather.BATCH: batch, weather.ANALYTICS: stats}, VIEWS):
            return run(spark, data)

    return on_tables


@query(f"""
WITH {BATCH}
SELECT city_name, strftime(measurement_time, '%Y-%m-%d') AS measurement_date,
       date_trunc('second', measurement_time) AS measurement_time, temperature, humidity, pressure,
       wind_speed, weather_condition
FROM batch
WHERE city_name = 'click' AND measurement_time >= DATE '2024-01-10'
  AND measurement_time < DATE '2024-01-26'
ORDER BY measurement_time DESC, city_name, temperature, humidity, pressure, wind_speed,
         weather_condition
LIMIT 100
""")
@_on_tables
def read_weather(spark: SparkSession, data: str) -> DataFrame:
    rows = weather.weather_data(spark, "2024-01-10", "2024-01-25", "click")
    return plain(text(rows, "measurement_date"), "measurement_time")


@query(f"""
WITH {LONG_STATS}
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, metric_type AS metric,
       round(round(avg_value, 9), 6) AS avg_value, min_value, max_value,
       round(round(std_dev, 9), 6) AS std_dev
FROM daily WHERE metric_type = 'wind_speed' AND d BETWEEN DATE '2024-01-05' AND DATE '2024-01-25'
""")
@_on_tables
def read_stats(spark: SparkSession, data: str) -> DataFrame:
    days = weather.weather_stats(spark, "wind_speed", "2024-01-05", "2024-01-25")
    return text(rounded(days, "avg_value", "std_dev"), "date")


@query(f"""
WITH {LONG_STATS},
recent AS (
  SELECT city_name, d, avg_value AS v FROM daily
  WHERE metric_type = 'humidity' AND d >= DATE '2024-01-16' AND d <= DATE '2024-01-30'),
slopes AS (
  SELECT city_name, count(*) AS points, arg_max(v, d) AS last_value,
         regr_slope(v, date_diff('day', DATE '2024-01-16', d)) AS s
  FROM recent GROUP BY 1)
SELECT city_name, CAST(points AS INTEGER) AS points, round(round(last_value, 9), 6) AS last_value,
       round(round(s, 9), 6) AS change_rate,
       CASE WHEN s > 0.1 THEN 'increasing' WHEN s < -0.1 THEN 'decreasing' ELSE 'stable' END
         AS trend_direction
FROM slopes
""")
@_on_tables
def read_trend(spark: SparkSession, data: str) -> DataFrame:
    trends = weather.weather_trend(spark, "humidity", 14, date(2024, 1, 30))
    flat = trends.select(
        "city_name",
        F.size("data_points").alias("points"),
        F.element_at("data_points", -1)["value"].alias("last_value"),
        "change_rate",
        "trend_direction",
    )
    return rounded(flat, "last_value", "change_rate")


@query(f"""
WITH {BATCH}
SELECT city_name, measurement_time AS "timestamp",
       CASE WHEN temperature > 35 THEN 'HIGH_TEMPERATURE' WHEN temperature < 5 THEN
            'LOW_TEMPERATURE' WHEN wind_speed > 15 THEN 'HIGH_WIND' ELSE 'HIGH_HUMIDITY' END
         AS alert_type,
       CASE WHEN temperature > 38 OR temperature < 2 OR wind_speed > 20 THEN 'critical'
            ELSE 'warning' END AS alert_level,
       CASE WHEN temperature > 35 OR temperature < 5 THEN temperature
            WHEN wind_speed > 15 THEN wind_speed ELSE humidity END AS value
FROM batch
WHERE measurement_time BETWEEN TIMESTAMP '2024-01-28 12:00:00' AND TIMESTAMP '2024-01-30 12:00:00'
  AND (temperature > 35 OR temperature < 5 OR wind_speed > 15 OR humidity > 90)
""")
@_on_tables
def read_alerts(spark: SparkSession, data: str) -> DataFrame:
    found = weather.weather_alerts(spark, 48, datetime(2024, 1, 30, 12))
    return found.select("city_name", "timestamp", "alert_type", "alert_level", "value")


@query(f"""
WITH {BATCH},
history AS (
  SELECT *, CAST(measurement_time AS DATE) AS d FROM batch
  WHERE measurement_time >= DATE '2024-01-07' AND measurement_time < DATE '2024-01-21'),
common AS (
  SELECT city_name, d, weather_condition AS c FROM history GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY city_name, d
                             ORDER BY count(*) DESC, weather_condition) = 1)
SELECT city_name, strftime(d + INTERVAL 365 DAY, '%Y-%m-%d') AS forecast_date,
       min(temperature) AS temperature_min, max(temperature) AS temperature_max,
       round(round(avg(humidity), 9), 6) AS humidity, any_value(c) AS weather_condition,
       round(round(100.0 * count(*) FILTER (WHERE lower(weather_condition) LIKE '%rain%')
                   / count(*), 9), 6) AS precipitation_probability
FROM history JOIN common USING (city_name, d) GROUP BY city_name, d
""")
@_on_tables
def read_forecast(spark: SparkSession, data: str) -> DataFrame:
    ahead = weather.weather_forecast(spark, 14, date(2025, 1, 5)).drop("temperature_avg")
    return text(rounded(ahead, "humidity", "precipitation_probability"), "forecast_date")


@query(f"""
WITH {BATCH}
SELECT city_name, measurement_time, temperature, humidity, pressure, wind_speed,
       weather_condition
FROM batch
QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY measurement_time DESC,
                           temperature DESC, humidity DESC) = 1
""")
@_on_tables
def view_latest(spark: SparkSession, data: str) -> DataFrame:
    weather.create_views(spark, "2024-01-31")
    return spark.table("latest_weather")


@query(f"""
WITH {LONG_STATS}
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, metric_type,
       CASE metric_type WHEN 'temperature' THEN '°C' WHEN 'humidity' THEN '%'
            WHEN 'pressure' THEN 'hPa' ELSE 'm/s' END AS unit,
       round(round(avg(avg_value) OVER (PARTITION BY city_name, metric_type ORDER BY d
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9), 6) AS moving_avg_7day
FROM daily
""")
@_on_tables
def view_trends(spark: SparkSession, data: str) -> DataFrame:
    weather.create_views(spark, "2024-01-31")
    rows = spark.sql("SELECT city_name, date, metric_type, unit, moving_avg_7day FROM weather_trends")
    return text(rounded(rows, "moving_avg_7day"), "date")


@query(f"""
WITH {BATCH}
SELECT city_name, event_id, measurement_time, temperature,
       row_number() OVER (PARTITION BY city_name ORDER BY measurement_time DESC, event_id DESC)
         AS row_num
FROM batch WHERE CAST(measurement_time AS DATE) = DATE '2024-01-30'
""")
def current_weather(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data).select("city_name", "event_id", "measurement_time", "temperature")
    return weather.current_weather(rows, date(2024, 1, 30), "event_id")


@query(f"""
WITH {BATCH},
daily AS (
  SELECT city_name, CAST(measurement_time AS DATE) AS d, avg(temperature) AS v FROM batch
  WHERE measurement_time >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2),
weeks AS (
  SELECT *, avg(v) OVER (PARTITION BY city_name ORDER BY d
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS a,
         avg(v) OVER (PARTITION BY city_name ORDER BY d
                      ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS b
  FROM daily)
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, round(round(v, 9), 6) AS avg_temp,
       round(round(a, 9), 6) AS temp_7day_moving_avg,
       CASE WHEN a > b THEN 'increasing' WHEN a < b THEN 'decreasing' ELSE 'stable' END AS temp_trend
FROM weeks
""")
@_on_tables
def report_trends(spark: SparkSession, data: str) -> DataFrame:
    weather.create_report_views(spark, datetime(2024, 1, 31))
    rows = spark.table("weather_trends_view").select(
        "city_name", "date", "avg_temp", "temp_7day_moving_avg", "temp_trend"
    )
    return text(rounded(rows, "avg_temp", "temp_7day_moving_avg"), "date")


@query(f"""
WITH {BATCH}
SELECT city_name, measurement_time, temperature, humidity, wind_speed, pressure,
       CASE WHEN temperature > 35 THEN 'HIGH_TEMPERATURE' WHEN temperature < 5 THEN
            'LOW_TEMPERATURE' WHEN wind_speed > 15 THEN 'HIGH_WIND' ELSE 'HIGH_HUMIDITY' END
         AS alert_type,
       CASE WHEN temperature > 38 OR temperature < 0 OR wind_speed > 20 THEN 'critical'
            ELSE 'warning' END AS alert_level
FROM batch
WHERE measurement_time >= TIMESTAMP '2024-01-29 12:00:00'
  AND (temperature > 35 OR temperature < 5 OR wind_speed > 15 OR humidity > 90)
""")
@_on_tables
def report_alerts(spark: SparkSession, data: str) -> DataFrame:
    weather.create_report_views(spark, datetime(2024, 1, 30, 12))
    return spark.table("weather_alerts_view")


@query(f"""
WITH {BATCH}
SELECT city_name, event_id, measurement_time, temperature, wind_speed,
       row_number() OVER (PARTITION BY city_name ORDER BY measurement_time DESC, event_id) AS row_num
FROM batch WHERE CAST(measurement_time AS DATE) = DATE '2024-01-30'
""")
@_on_tables
def report_current(spark: SparkSession, data: str) -> DataFrame:
    weather.create_report_views(spark, datetime(2024, 1, 30, 12))
    return spark.table("current_weather_view").select(
        "city_name", "event_id", "measurement_time", "temperature", "wind_speed",
        F.col("row_num").cast("long").alias("row_num"),
    )


NULLED = "CASE WHEN event_id % 7 <> 0 THEN city_name END"


@query(f"""
WITH {READINGS}, odd AS (SELECT * REPLACE ({NULLED} AS city_name) FROM readings)
SELECT city_name, event_id, measurement_time, temperature FROM odd
QUALIFY row_number() OVER (PARTITION BY city_name ORDER BY measurement_time DESC, event_id DESC) = 1
""")
def newest_with_null_keys(spark: SparkSession, data: str) -> DataFrame:
    odd = readings(spark, data).withColumn("city_name", F.expr(NULLED))
    rows = ranking.newest_per_key(odd, ["city_name"], "measurement_time", "event_id")
    return rows.select("city_name", "event_id", "measurement_time", "temperature")
