"""Threshold alerts over the readings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import alerts
from tablestream.operators.cooldown import cooldown
from tablestream.operators.shape import sensor_row
from tablestream.plans.fixtures import READINGS, readings, table
from tablestream.plans.registry import query

VIOLATED = "(temperature > 35 OR temperature < 5 OR wind_speed > 15 OR humidity > 90)"
ALERT_TYPE = """CASE WHEN temperature > 35 THEN 'HIGH_TEMPERATURE'
  WHEN temperature < 5 THEN 'LOW_TEMPERATURE' WHEN wind_speed > 15 THEN 'HIGH_WIND'
  WHEN humidity > 90 THEN 'HIGH_HUMIDITY' ELSE 'OTHER' END"""


@query(f"""
WITH {READINGS}
SELECT event_id, city_name, measurement_time, {ALERT_TYPE} AS alert_type,
       CASE WHEN temperature > 38 OR temperature < 2 OR wind_speed > 20 THEN 'critical'
            ELSE 'warning' END AS alert_level,
       CASE WHEN temperature > 35 THEN 'High temperature: ' || temperature || '°C'
            WHEN temperature < 5 THEN 'Low temperature: ' || temperature || '°C'
            WHEN wind_speed > 15 THEN 'High wind speed: ' || wind_speed || ' m/s'
            ELSE 'High humidity: ' || humidity || '%' END AS message,
       CASE WHEN temperature > 35 OR temperature < 5 THEN temperature
            WHEN wind_speed > 15 THEN wind_speed ELSE humidity END AS value,
       CAST(CASE WHEN temperature > 35 THEN 35 WHEN temperature < 5 THEN 5
            WHEN wind_speed > 15 THEN 15 ELSE 90 END AS DOUBLE) AS threshold
FROM readings WHERE {VIOLATED}
""")
def alert_class(spark: SparkSession, data: str) -> DataFrame:
    found = alerts.first_alert(readings(spark, data))
    return found.select(
        "event_id", "city_name", "measurement_time", "alert_type", "alert_level", "message",
        "value", "threshold",
    )


@query(f"""
WITH {READINGS}
SELECT event_id, city_name, {ALERT_TYPE} AS alert_type,
       CASE WHEN temperature > 38 OR temperature < 0 OR wind_speed > 20 THEN 'critical'
            WHEN {VIOLATED} THEN 'warning' ELSE 'info' END AS alert_level
FROM readings
""")
def alert_view_levels(spark: SparkSession, data: str) -> DataFrame:
    rows = alerts.classify(readings(spark, data), critical=alerts.VIEW_LEVELS)
    return rows.select("event_id", "city_name", "alert_type", "alert_level")


ALL_RULES = f"""
{READINGS},
alerts AS (
  SELECT event_id, city_name, measurement_time AS "timestamp", 'HIGH_TEMPERATURE' AS alert_type,
         CASE WHEN temperature > 38 THEN 'critical' ELSE 'warning' END AS alert_level,
         'High temperature detected: ' || temperature || '°C' AS message, temperature AS value,
         35.0::DOUBLE AS threshold FROM readings WHERE temperature > 35
  UNION ALL
  SELECT event_id, city_name, measurement_time, 'LOW_TEMPERATURE',
         CASE WHEN temperature < 2 THEN 'critical' ELSE 'warning' END,
         'Low temperature detected: ' || temperature || '°C', temperature, 5.0::DOUBLE
  FROM readings WHERE temperature < 5
  UNION ALL
  SELECT event_id, city_name, measurement_time, 'HIGH_WIND',
         CASE WHEN wind_speed > 20 THEN 'critical' ELSE 'warning' END,
         'High wind speed detected: ' || wind_speed || ' m/s', wind_speed, 15.0::DOUBLE
  FROM readings WHERE wind_speed > 15
  UNION ALL
  SELECT event_id, city_name, measurement_time, 'HIGH_HUMIDITY', 'warning',
         'High humidity detected: ' || humidity || '%', humidity, 90.0::DOUBLE
  FROM readings WHERE humidity > 90)
"""


def all_alerts(rows: DataFrame) -> DataFrame:
    return alerts.explode_alerts(rows.withColumnRenamed("measurement_time", "timestamp"))


@query(f"WITH {ALL_RULES} SELECT * FROM alerts")
def alert_all_rules(spark: SparkSession, data: str) -> DataFrame:
    return all_alerts(readings(spark, data))


@query(f"""
WITH {READINGS}
SELECT event_id, CASE WHEN temperature > 35 THEN 'EXTREME_HEAT'
       WHEN temperature < 5 THEN 'EXTREME_COLD' WHEN wind_speed > 15 THEN 'HIGH_WIND'
       WHEN humidity > 90 THEN 'HIGH_HUMIDITY' END AS alert
FROM readings
""")
def alert_flag(spark: SparkSession, data: str) -> DataFrame:
    return readings(spark, data).select("event_id", alerts.alert_flag().alias("alert"))


@query(f"""
WITH {READINGS}
SELECT {ALERT_TYPE} AS alert_type, count(*) AS alerts FROM readings WHERE {VIOLATED} GROUP BY 1
UNION ALL SELECT NULL, count(*) FROM readings WHERE {VIOLATED}
""")
def alert_counts(spark: SparkSession, data: str) -> DataFrame:
    return alerts.alert_counts(alerts.first_alert(readings(spark, data)))


def sensor_messages(events: DataFrame) -> DataFrame:
    """Events as nested sensor messages."""
    return events.select(
        F.col("event_id").cast("string").alias("message_id"),
        F.col("user_id").cast("int").alias("sensor_id"),
        F.struct(
            F.col("value").alias("temperature"),
            (F.col("user_id") * 1.0).cast("double").alias("pressure"),
            F.lit(0.5).alias("vibration"),
        ).alias("message"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ssXXX").alias("timestamp"),
    )


THRESHOLD_SQL = """
SELECT '{"message_id":"' || event_id || '","sensor_id":' || user_id || ',"temperature":' || value
       || ',"alert":"High temperature detected","timestamp":"'
       || strftime(ts, '%Y-%m-%dT%H:%M:%SZ') || '"}' AS value
FROM events WHERE value > 30
"""


@query(THRESHOLD_SQL)
def threshold_json(spark: SparkSession, data: str) -> DataFrame:
    events = table(spark, data, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    return alerts.threshold_alerts(sensor_messages(events))


@query("""
SELECT CAST(event_id AS VARCHAR) AS message_id, CAST(user_id AS INTEGER) AS sensor_id,
       '{"temperature":' || value || ',"pressure":' || CAST(user_id AS DOUBLE)
       || ',"vibration":0.5}' AS message, date_trunc('second', ts) AS "timestamp"
FROM events
""")
def sensor_rows(spark: SparkSession, data: str) -> DataFrame:
    events = table(spark, data, "events")
    events = events.withColumn("ts", F.col("ts").cast("timestamp"))
    rows = sensor_row(sensor_messages(events))
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


COOLDOWN_SQL = f"""
WITH RECURSIVE {ALL_RULES},
sent AS (
  SELECT city_name, alert_type, min("timestamp") AS t FROM alerts GROUP BY 1, 2
  UNION ALL
  SELECT s.city_name, s.alert_type, min(a."timestamp")
  FROM sent s JOIN alerts a ON a.city_name = s.city_name AND a.alert_type = s.alert_type
    AND a."timestamp" >= s.t + INTERVAL 1 HOUR
  GROUP BY 1, 2)
SELECT a.event_id, a.city_name, a."timestamp", a.alert_type, a.alert_level, a.message, a.value,
       a.threshold
FROM alerts a JOIN sent s
  ON a.city_name = s.city_name AND a.alert_type = s.alert_type AND a."timestamp" = s.t
QUALIFY row_number() OVER (PARTITION BY a.city_name, a.alert_type, a."timestamp"
                           ORDER BY a.event_id) = 1
"""


@query(COOLDOWN_SQL)
def cooldown_alerts(spark: SparkSession, data: str) -> DataFrame:
    found = all_alerts(readings(spark, data))
    return cooldown(found, ["city_name", "alert_type"], "timestamp", "event_id", 3600)
