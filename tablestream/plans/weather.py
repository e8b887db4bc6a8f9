"""Readings: parsing, daily statistics, trends and dashboard extracts."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import aggregates, joins, ordered, ranking, series, shape
from tablestream.plans.fixtures import (
    AS_OF,
    CITIES,
    HOURLY,
    READINGS,
    clicks,
    device,
    hourly,
    plain,
    raw_weather,
    readings,
    rounded,
    table,
    text,
)
from tablestream.plans.registry import query
from tablestream.schemas import RAW_WEATHER, READING_MESSAGE
from tablestream.sources.readers import decode_json, named_views, resolve_table
from tablestream.streaming import windows

DAY, TIME = "date", "measurement_time"
LAST_DAY = date(2024, 1, 30)

RAW_SQL = """
raw AS (
  SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k,
         date_trunc('day', ts) + INTERVAL 6 HOUR AS sunrise,
         date_trunc('day', ts) + INTERVAL 17 HOUR
           + INTERVAL 30 MINUTE * (user_id % 3) AS sunset
  FROM events)
"""


@query(f"""
WITH {RAW_SQL}
SELECT event_type AS city_name, upper(event_type) AS city_original_name,
       CAST(user_id AS DOUBLE) AS longitude, user_id / 2 AS latitude, value AS temperature,
       round(round(value - 1.5, 9), 6) AS feels_like, k AS humidity, 990 + k / 2 AS pressure,
       CAST(user_id % 25 AS DOUBLE) AS wind_speed, CAST(user_id AS DOUBLE) AS wind_direction,
       k AS cloudiness,
       CASE user_id % 3 WHEN 1 THEN 'Clouds' WHEN 2 THEN 'Rain' END AS weather_condition,
       CASE user_id % 3 WHEN 1 THEN event_type WHEN 2 THEN 'light rain' END
         AS weather_description,
       date_trunc('second', ts) AS measurement_time, sunrise, sunset,
       TIMESTAMP '2024-01-31 01:00:00' AS processing_time, '2024-01-31' AS processing_date,
       11.0::DOUBLE + (user_id % 3) / 2 AS day_length_hours
FROM raw
""")
def flatten_json(spark: SparkSession, data: str) -> DataFrame:
    records = decode_json(raw_weather(spark, data), RAW_WEATHER)
    flat = shape.flatten_weather(records, AS_OF, "2024-01-31 01:00:00")
    flat = rounded(flat, "feels_like", "day_length_hours")
    return plain(
        text(flat, "processing_date"), "measurement_time", "sunrise", "sunset", "processing_time"
    )


@query(f"""
WITH {RAW_SQL}
SELECT event_type AS city_name, CAST(event_id AS DOUBLE) AS id, 'Rain' AS weather_condition,
       'light rain' AS weather_description
FROM raw WHERE user_id % 3 = 2
UNION ALL
SELECT event_type, CAST(event_id AS DOUBLE), 'Clouds', event_type FROM raw WHERE user_id % 3 <> 0
""")
def explode_conditions(spark: SparkSession, data: str) -> DataFrame:
    records = decode_json(raw_weather(spark, data), RAW_WEATHER)
    return shape.explode_conditions(records.select("city_name", "id", "weather"))


@query(f"""
WITH {READINGS}
SELECT city_name, temperature, humidity, pressure, wind_speed,
       CASE WHEN event_id % 2 = 0 THEN 'Rain' ELSE 'Clouds' END AS weather_condition,
       CASE WHEN event_id % 13 = 0 THEN TIMESTAMP '2024-01-31 00:00:00'
            WHEN event_id % 2 = 0 THEN date_trunc('second', measurement_time)
            ELSE measurement_time END AS "timestamp",
       TIMESTAMP '2024-01-31 00:00:00' AS processing_time
FROM readings WHERE event_id % 17 <> 0
""")
def normalise_two_shapes(spark: SparkSession, data: str) -> DataFrame:
    even, timed = F.col("event_id") % 2 == 0, F.col("event_id") % 13 != 0
    rows = readings(spark, data)
    city = F.when(F.col("event_id") % 17 != 0, F.col("city_name")).alias("city_name")
    nested = F.to_json(
        F.struct(
            city,
            F.struct(F.col("temperature").alias("temp"), "humidity", "pressure").alias("main"),
            F.struct(F.col("wind_speed").alias("speed")).alias("wind"),
            F.array(F.struct(F.lit("Rain").alias("main"))).alias("weather"),
            F.when(timed, F.unix_timestamp(TIME)).alias("dt"),
        )
    )
    iso = F.date_format(TIME, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    flat = F.to_json(
        F.struct(
            city, "temperature", "humidity", "pressure", "wind_speed",
            F.lit("Clouds").alias("weather_condition"),
            F.when(timed, iso).alias("timestamp"),
        )
    )
    messages = rows.select(F.when(even, nested).otherwise(flat).alias("value"))
    arrival = F.lit(AS_OF).cast("timestamp")
    flat_rows = shape.normalise_reading(decode_json(messages, READING_MESSAGE), arrival)
    return plain(flat_rows, "timestamp", "processing_time")


@query(f"""
WITH {HOURLY}
SELECT 'batch' AS layout, city_name, strftime(measurement_time, '%Y-%m-%d') AS measurement_date,
       date_trunc('second', measurement_time) AS measurement_time, temperature, humidity,
       pressure, wind_speed, city_name AS weather_condition FROM readings
UNION ALL
SELECT 'streaming', city_name, strftime(measurement_time, '%Y-%m-%d'),
       date_trunc('second', measurement_time), temperature, humidity, pressure, wind_speed,
       city_name FROM readings
UNION ALL
SELECT 'hourly', city_name, strftime(window_start, '%Y-%m-%d'), window_start,
       round(round(avg_temperature, 9), 6), round(round(avg_humidity, 9), 6),
       round(round(avg_pressure, 9), 6), NULL, NULL
FROM hourly
""")
def unify_layouts(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data).withColumn("weather_condition", F.col("city_name"))
    tables = {
        "batch": rows.withColumn("processing_date", F.to_date(TIME)),
        "streaming": rows.withColumnRenamed(TIME, "timestamp"),
        "hourly": hourly(spark, data),
    }
    parts = [
        shape.unify_readings(df, layout).withColumn("layout", F.lit(layout))
        for layout, df in tables.items()
    ]
    union = parts[0].unionByName(parts[1]).unionByName(parts[2])
    union = rounded(union, "temperature", "humidity", "pressure")
    return plain(text(union, "measurement_date"), TIME)


@query(f"""
WITH {READINGS}
SELECT city_name, event_id, measurement_time, temperature, humidity, wind_speed, pressure
FROM readings
QUALIFY row_number() OVER (PARTITION BY city_name
                           ORDER BY measurement_time DESC, event_id DESC) = 1
""")
def latest_reading(spark: SparkSession, data: str) -> DataFrame:
    return ranking.newest_per_key(readings(spark, data), ["city_name"], TIME, "event_id")


@query(f"""
WITH {READINGS}
SELECT city_name, event_id, measurement_time, temperature,
       row_number() OVER (PARTITION BY city_name
                          ORDER BY measurement_time DESC, event_id DESC) AS row_num
FROM readings
""")
def reading_ranks(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data).select("city_name", "event_id", TIME, "temperature")
    return ranking.rank_newest(rows, "city_name", TIME, "event_id")


@query(f"""
WITH {READINGS}
SELECT * FROM readings
WHERE measurement_time >= DATE '2024-01-10' AND measurement_time < DATE '2024-01-21'
ORDER BY measurement_time DESC, event_id DESC LIMIT 100
""")
def newest_readings(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data)
    return ranking.newest_rows(rows, TIME, "event_id", "2024-01-10", "2024-01-20")


@query(f"""
WITH {READINGS}
SELECT city_name, strftime(measurement_time, '%Y-%m-%d') AS date,
       round(round(avg(temperature), 9), 6) AS avg_temp, max(temperature) AS max_temp,
       min(temperature) AS min_temp, round(round(avg(humidity), 9), 6) AS avg_humidity,
       round(round(avg(pressure), 9), 6) AS avg_pressure,
       round(round(avg(wind_speed), 9), 6) AS avg_wind_speed,
       count(*) AS measurement_count
FROM readings WHERE measurement_time >= DATE '2024-01-01' GROUP BY 1, 2
""")
def daily_summary(spark: SparkSession, data: str) -> DataFrame:
    days = aggregates.daily_summary(readings(spark, data), AS_OF, 30)
    days = rounded(days, "avg_temp", "avg_humidity", "avg_pressure", "avg_wind_speed")
    return text(days, DAY)


LONG_STATS = f"""
{READINGS},
long AS (
  SELECT city_name, CAST(measurement_time AS DATE) AS d, metric_type, v
  FROM readings
  UNPIVOT (v FOR metric_type IN (temperature, humidity, pressure, wind_speed))),
daily AS (
  SELECT city_name, d, metric_type, avg(v) AS avg_value, min(v) AS min_value,
         max(v) AS max_value, stddev_samp(v) AS std_dev
  FROM long GROUP BY 1, 2, 3)
"""


def _daily_stats(spark: SparkSession, data: str) -> DataFrame:
    return aggregates.metric_stats(readings(spark, data), "city_name", TIME)


@query(f"""
WITH {LONG_STATS}
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, metric_type,
       round(round(avg_value, 9), 6) AS avg_value,
       min_value, max_value, round(round(std_dev, 9), 6) AS std_dev,
       CASE metric_type WHEN 'temperature' THEN '°C' WHEN 'humidity' THEN '%'
            WHEN 'pressure' THEN 'hPa' ELSE 'm/s' END AS unit
FROM daily
""")
def metric_stats(spark: SparkSession, data: str) -> DataFrame:
    stats = aggregates.with_units(_daily_stats(spark, data))
    return text(rounded(stats, "avg_value", "std_dev"), DAY)


@query(f"""
WITH {HOURLY}
SELECT city_name, strftime(window_start, '%Y-%m-%d') AS date, 'temperature' AS metric_type,
       round(round(avg(avg_temperature), 9), 6) AS avg_value,
       round(round(min(min_temperature), 9), 6) AS min_value,
       round(round(max(max_temperature), 9), 6) AS max_value,
       round(round(stddev_samp(avg_temperature), 9), 6) AS std_dev FROM hourly GROUP BY 1, 2
UNION ALL
SELECT city_name, strftime(window_start, '%Y-%m-%d'), 'humidity',
       round(round(avg(avg_humidity), 9), 6),
       round(round(min(avg_humidity), 9), 6), round(round(max(avg_humidity), 9), 6),
       round(round(stddev_samp(avg_humidity), 9), 6) FROM hourly GROUP BY 1, 2
UNION ALL
SELECT city_name, strftime(window_start, '%Y-%m-%d'), 'pressure',
       round(round(avg(avg_pressure), 9), 6),
       round(round(min(avg_pressure), 9), 6), round(round(max(avg_pressure), 9), 6),
       round(round(stddev_samp(avg_pressure), 9), 6) FROM hourly GROUP BY 1, 2
""")
def hourly_stats_of_stats(spark: SparkSession, data: str) -> DataFrame:
    stats = aggregates.hourly_metric_stats(hourly(spark, data))
    return text(rounded(stats, "avg_value", "min_value", "max_value", "std_dev"), DAY)


@query(f"""
WITH {READINGS}
SELECT city_name, strftime(measurement_time, '%Y-%m-%d') AS date, 'humidity' AS metric,
       round(round(avg(humidity), 9), 6) AS avg_value, min(humidity) AS min_value,
       max(humidity) AS max_value, round(round(stddev_samp(humidity), 9), 6) AS std_dev
FROM readings
WHERE measurement_time >= DATE '2024-01-05' AND measurement_time < DATE '2024-01-26'
GROUP BY 1, 2
""")
def stats_one_metric(spark: SparkSession, data: str) -> DataFrame:
    days = aggregates.stats(
        readings(spark, data), "humidity", TIME, start="2024-01-05", end="2024-01-25"
    )
    return text(rounded(days, "avg_value", "std_dev"), DAY)


@query(f"""
WITH {READINGS}
SELECT city_name, round(round(avg(temperature), 9), 6) AS avg_temperature,
       round(round(avg(humidity), 9), 6) AS avg_humidity,
       round(round(avg(pressure), 9), 6) AS avg_pressure,
       round(round(avg(wind_speed), 9), 6) AS avg_wind_speed
FROM readings WHERE measurement_time >= DATE '2024-01-24' GROUP BY 1
""")
def key_comparison_wide(spark: SparkSession, data: str) -> DataFrame:
    wide = aggregates.key_comparison(readings(spark, data), AS_OF)
    return rounded(wide, *[f"avg_{m}" for m in aggregates.METRICS])


@query(f"""
WITH {LONG_STATS},
recent AS (
  SELECT city_name, metric_type, avg(avg_value) AS v FROM daily
  WHERE d >= DATE '2024-01-24' GROUP BY 1, 2)
SELECT city_name,
       round(round(max(CASE WHEN metric_type = 'temperature' THEN v END), 9), 6) AS avg_temperature,
       round(round(max(CASE WHEN metric_type = 'humidity' THEN v END), 9), 6) AS avg_humidity,
       round(round(max(CASE WHEN metric_type = 'pressure' THEN v END), 9), 6) AS avg_pressure,
       round(round(max(CASE WHEN metric_type = 'wind_speed' THEN v END), 9), 6) AS avg_wind_speed
FROM recent GROUP BY 1
""")
def key_comparison_pivot(spark: SparkSession, data: str) -> DataFrame:
    wide = aggregates.key_comparison_pivot(_daily_stats(spark, data), AS_OF)
    return rounded(wide, *[f"avg_{m}" for m in aggregates.METRICS])


TREND = f"""
{READINGS},
daily AS (
  SELECT city_name, CAST(measurement_time AS DATE) AS d, avg(temperature) AS v
  FROM readings WHERE measurement_time >= DATE '2024-01-01'
    AND measurement_time < DATE '2024-02-01' GROUP BY 1, 2),
slopes AS (
  SELECT city_name, regr_slope(v, date_diff('day', DATE '2024-01-01', d)) AS s
  FROM daily GROUP BY 1),
trends AS (
  SELECT city_name, round(round(s, 9), 6) AS change_rate,
         CASE WHEN s > 0.1 THEN 'increasing' WHEN s < -0.1 THEN 'decreasing' ELSE 'stable' END
           AS trend_direction
  FROM slopes)
"""


@query(f"""
WITH {TREND}
SELECT city_name, trend_direction, change_rate, strftime(d, '%Y-%m-%d') AS date,
       round(round(v, 9), 6) AS value
FROM daily JOIN trends USING (city_name)
""")
def trend_slope(spark: SparkSession, data: str) -> DataFrame:
    points = series.trend_series(
        readings(spark, data), "city_name", TIME, "temperature", 30, date(2024, 1, 31)
    )
    return text(rounded(points, "value", "change_rate"), DAY)


@query(f"""
WITH {TREND}
SELECT city_name, 'temperature' AS metric, trend_direction, change_rate,
       CAST(row_number() OVER (PARTITION BY city_name ORDER BY d) - 1 AS INTEGER) AS position,
       strftime(d, '%Y-%m-%d') AS date, round(round(v, 9), 6) AS value
FROM daily JOIN trends USING (city_name)
""")
def trend_points(spark: SparkSession, data: str) -> DataFrame:
    trends = series.trend(
        readings(spark, data), "city_name", TIME, "temperature", 30, date(2024, 1, 31)
    )
    points = F.posexplode("data_points").alias("position", "point")
    flat = trends.select("city_name", "metric", "trend_direction", "change_rate", points)
    flat = flat.select("*", "point.date", "point.value").drop("point")
    return text(rounded(flat, "value", "change_rate"), DAY)


@query(f"""
WITH {LONG_STATS}
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, metric_type,
       round(round(avg_value, 9), 6) AS avg_value,
       round(round(avg(avg_value) OVER (PARTITION BY city_name, metric_type ORDER BY d
             ROWS BETWEEN 6 PRECEDING AND CURRENT ROW), 9), 6) AS moving_avg_7day
FROM daily
""")
def moving_average_7(spark: SparkSession, data: str) -> DataFrame:
    stats = _daily_stats(spark, data).select("city_name", DAY, "metric_type", "avg_value")
    moving = series.moving_average(
        stats, ["city_name", "metric_type"], DAY, "avg_value", "moving_avg_7day"
    )
    return text(rounded(moving, "avg_value", "moving_avg_7day"), DAY)


@query(f"""
WITH {READINGS},
daily AS (
  SELECT city_name, CAST(measurement_time AS DATE) AS d, avg(temperature) AS v
  FROM readings GROUP BY 1, 2),
both_weeks AS (
  SELECT *, avg(v) OVER (PARTITION BY city_name ORDER BY d
                         ROWS BETWEEN 6 PRECEDING AND CURRENT ROW) AS a,
         avg(v) OVER (PARTITION BY city_name ORDER BY d
                      ROWS BETWEEN 13 PRECEDING AND 7 PRECEDING) AS b
  FROM daily)
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, round(round(v, 9), 6) AS value,
       round(round(a, 9), 6) AS moving_avg, round(round(b, 9), 6) AS previous_avg,
       CASE WHEN a > b THEN 'increasing' WHEN a < b THEN 'decreasing' ELSE 'stable' END AS trend
FROM both_weeks
""")
def week_over_week(spark: SparkSession, data: str) -> DataFrame:
    daily = series.daily_mean(readings(spark, data), "city_name", TIME, "temperature")
    weeks = series.week_over_week(daily, "city_name", DAY, "value")
    return text(rounded(weeks, "value", "moving_avg", "previous_avg"), DAY)


@query("""
WITH pairs AS (
  SELECT CAST(ts AS DATE) AS d, event_type AS city_name, count(*) AS n FROM events
  WHERE ts >= DATE '2024-01-24' AND ts < DATE '2024-01-31' GROUP BY 1, 2)
SELECT strftime(d, '%Y-%m-%d') AS date, city_name, CAST(sum(n) AS BIGINT) AS record_count,
       CAST(grouping(d, city_name) AS INTEGER) AS level
FROM pairs GROUP BY GROUPING SETS ((d, city_name), (d), (city_name), ())
""")
def availability_rollup(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data).withColumn(DAY, F.to_date(TIME))
    return text(aggregates.availability(rows, "city_name", DAY, LAST_DAY, 7), DAY)


@query("""
WITH grid AS (
  SELECT d, user_id FROM (SELECT DISTINCT user_id FROM events),
    (SELECT CAST(range AS DATE) AS d FROM range(DATE '2024-01-01', DATE '2024-01-31',
                                                INTERVAL 1 DAY)))
SELECT strftime(d, '%Y-%m-%d') AS date, user_id FROM grid
WHERE NOT EXISTS (SELECT 1 FROM events e WHERE e.user_id = grid.user_id
                  AND CAST(e.ts AS DATE) = grid.d)
""")
def missing_grid(spark: SparkSession, data: str) -> DataFrame:
    events = table(spark, data, "events").withColumn(DAY, F.to_date("ts"))
    return text(joins.missing_grid(events, events, "user_id", DAY, LAST_DAY, 30), DAY)


@query("""
WITH c AS (
  SELECT event_type, CASE WHEN event_id % 11 <> 0 THEN 'C' || (user_id % 7) ELSE 'unknown' END
           AS country, CAST(round(value * 100) AS INTEGER) AS duration FROM events)
SELECT event_type, country, count(*) AS clicks, round(round(avg(duration), 9), 6) AS avg_duration
FROM c GROUP BY 1, 2
""")
def click_rollup(spark: SparkSession, data: str) -> DataFrame:
    rows = shape.click_row(clicks(spark, data))
    return rounded(aggregates.click_rollup(rows), "avg_duration")


@query("""
SELECT CAST(event_id AS VARCHAR) AS event_id, event_type,
       CASE WHEN event_id % 11 <> 0 THEN 'C' || (user_id % 7) END AS country,
       CASE WHEN event_id % 2 = 1 THEN CASE WHEN event_id % 4 = 1 THEN 'mobile'
            ELSE 'desktop' END END AS device_type,
       CASE WHEN event_id % 2 = 1 THEN 'v2' ELSE 'v1' END AS schema_version
FROM events
""")
def mixed_versions(spark: SparkSession, data: str) -> DataFrame:
    number = F.col("event_id").cast("long")
    rows = clicks(spark, data).select("event_id", "event_type", "country")
    old = rows.filter(number % 2 == 0).withColumn("schema_version", F.lit("v1"))
    new = rows.filter(number % 2 == 1).withColumns(
        {"schema_version": F.lit("v2"), "device_type": device(number)}
    )
    return shape.read_versions(old, new)


@query("""
SELECT CASE WHEN event_id % 2 = 1 THEN 'v2' ELSE 'v1' END AS schema_version, count(*) AS records
FROM events GROUP BY 1
""")
def version_distribution(spark: SparkSession, data: str) -> DataFrame:
    return aggregates.version_counts(mixed_versions(spark, data))


@query(f"""
WITH {LONG_STATS}
SELECT strftime(d, '%Y-%m-%d') AS date,
       {", ".join(f"round(round(avg(avg_value) FILTER (WHERE city_name = '{c}'), 9), 6) AS {c}"
                  for c in CITIES)}
FROM daily WHERE metric_type = 'temperature' GROUP BY 1
""")
def dashboard_matrix(spark: SparkSession, data: str) -> DataFrame:
    matrix = aggregates.metric_matrix(_daily_stats(spark, data), "temperature", CITIES)
    return text(rounded(matrix, *CITIES), DAY)


@query(f"""
WITH {LONG_STATS}
SELECT city_name, metric_type,
       round(round(avg(avg_value), 9), 6) AS avg_value, min(min_value) AS min_value,
       max(max_value) AS max_value, round(round(avg(std_dev), 9), 6) AS std_dev
FROM daily GROUP BY 1, 2
""")
def dashboard_profile(spark: SparkSession, data: str) -> DataFrame:
    return rounded(aggregates.metric_profile(_daily_stats(spark, data)), "avg_value", "std_dev")


HOURLY_OUT = """city_name, window_start, window_end,
       round(round(avg_temperature, 9), 6) AS avg_temperature,
       max_temperature, min_temperature, round(round(avg_humidity, 9), 6) AS avg_humidity,
       round(round(avg_pressure, 9), 6) AS avg_pressure"""


def _hourly_out(df: DataFrame) -> DataFrame:
    return rounded(df, "avg_temperature", "avg_humidity", "avg_pressure")


@query(f"""
WITH {HOURLY}
SELECT {HOURLY_OUT} FROM hourly WHERE window_start = (SELECT max(window_start) FROM hourly)
""")
def latest_window(spark: SparkSession, data: str) -> DataFrame:
    return _hourly_out(aggregates.newest_window(hourly(spark, data)))


@query(f"""
WITH {HOURLY}
SELECT {HOURLY_OUT} FROM hourly WHERE window_start >= TIMESTAMP '2024-01-30 21:00:00'
""")
def realtime_windows(spark: SparkSession, data: str) -> DataFrame:
    recent = aggregates.recent_windows(hourly(spark, data), "2024-01-31 00:00:00", 3)
    return _hourly_out(recent).orderBy(F.desc("window_start"), "city_name")


@query(f"""
WITH {READINGS}
SELECT city_name, round(round(avg(temperature), 9), 6) AS avg_temp, count(*) AS measurement_count
FROM readings WHERE CAST(measurement_time AS DATE) = DATE '2024-01-30' GROUP BY 1
""")
def yesterday_comparison(spark: SparkSession, data: str) -> DataFrame:
    days = aggregates.daily_summary(readings(spark, data), AS_OF, 30)
    rows = aggregates.of_day(days, DAY, LAST_DAY)
    return rounded(rows.select("city_name", "avg_temp", "measurement_count"), "avg_temp")


@query("""
SELECT time_bucket(INTERVAL 5 SECOND, ts) AS bin_start, count(*) / 5 AS events_per_second
FROM events GROUP BY 1
""")
def throughput_bins(spark: SparkSession, data: str) -> DataFrame:
    return windows.throughput(table(spark, data, "events"), "ts")


@query("""
SELECT count(*) AS events FROM events WHERE ts >= TIMESTAMP '2024-01-30 22:00:00'
""")
def recent_events(spark: SparkSession, data: str) -> DataFrame:
    as_of = F.lit("2024-01-30 22:01:00").cast("timestamp_ntz")
    return windows.recent_events(table(spark, data, "events"), "ts", as_of)


@query("""
SELECT event_id, ts, value AS latency,
       round(round(avg(value) OVER (ORDER BY ts, event_id ROWS BETWEEN 59 PRECEDING AND CURRENT ROW), 9), 6)
         AS rolling_latency
FROM events
""")
def rolling_latency(spark: SparkSession, data: str) -> DataFrame:
    rows = table(spark, data, "events").select("event_id", "ts", F.col("value").alias("latency"))
    order = [F.asc("ts"), F.asc("event_id")]
    mean = ordered.trailing_mean(rows, [], order, "latency", 60, "rolling_latency")
    return rounded(mean, "rolling_latency")


@query(f"""
WITH {HOURLY}
SELECT {HOURLY_OUT} FROM hourly
""")
def best_table(spark: SparkSession, data: str) -> DataFrame:
    with named_views(spark, {"weather_streaming_hourly": hourly(spark, data)}):
        name = resolve_table(spark, ["weather_analytics_absent", "weather_streaming_hourly"])
        return _hourly_out(spark.sql(f"SELECT * FROM {name}"))
