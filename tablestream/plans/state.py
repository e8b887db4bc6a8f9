"""Streams with keyed state, stopped and started again between their inputs."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import alerts
from tablestream.plans.alerts import ALL_RULES
from tablestream.plans.fixtures import READINGS, plain, reading_columns, table
from tablestream.plans.registry import query
from tablestream.session import run_dir, use_utc
from tablestream.streaming import keyed, sinks

DROPS = 4


def _timed(spark: SparkSession, data: str) -> DataFrame:
    events = table(use_utc(spark), data, "events")
    return events.withColumn("ts", F.col("ts").cast("timestamp"))


def _in_drops(rows: DataFrame, name: str, drop: Column, start: Callable[[DataFrame, str, str], object]) -> str:
    """Feed ``rows`` to a stream by their number ``drop`` (0 to DROPS - 1), which is started anew, from
    its checkpoint, for each. Returns the folder of its output."""
    spark = rows.sparkSession
    root = run_dir(spark, name)
    rows.withColumn("drop", drop).write.partitionBy("drop").parquet(f"{root}/all")
    for k in range(DROPS):
        part = spark.read.schema(rows.schema).parquet(f"{root}/all/drop={k}")
        part.write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in")
        start(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def _by_time(rows: DataFrame, jitter: Column) -> Column:
    """Drops in the order of ts, but for a delay of each row. Every drop has rows at any scale."""
    arrival = F.unix_micros("ts") + jitter * 1_000_000
    borders = rows.agg(F.percentile_approx(arrival, [k / DROPS for k in range(1, DROPS)])).first()[0] or []
    return sum(((arrival >= b).cast("int") for b in borders), F.lit(0))


@query(f"""
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
WHERE a."timestamp" <= (SELECT date_trunc('milliseconds', max("timestamp")) - INTERVAL 10 MINUTE FROM alerts)
QUALIFY row_number() OVER (PARTITION BY a.city_name, a.alert_type, a."timestamp"
                           ORDER BY a.event_id) = 1
""")
def stream_keyed_cooldown(spark: SparkSession, data: str) -> DataFrame:
    """Events come up to nine minutes late, so out of order within and across four batches; between
    them the query is stopped. The last ten minutes of alerts still wait in the state."""
    rows = _timed(spark, data).filter("ts IS NOT NULL")

    def start(stream, out, checkpoint):
        found = alerts.explode_alerts(reading_columns(stream, "timestamp"))
        sent = keyed.cooled_down(found, ["city_name", "alert_type"], "timestamp", "event_id")
        return sinks.to_files(sent, out, checkpoint, available=True)

    out = _in_drops(rows, "keyed-cooldown", _by_time(rows, F.col("event_id") % 540), start)
    return plain(spark.read.parquet(out), "timestamp")


@query("""
SELECT event_id, user_id, ts, date_trunc('minute', ts) AS window_start,
       row_number() OVER (PARTITION BY user_id, date_trunc('minute', ts) ORDER BY ts, event_id) AS events_so_far
FROM events WHERE ts IS NOT NULL
""")
def stream_running_minute(spark: SparkSession, data: str) -> DataFrame:
    rows = _timed(spark, data).select("event_id", "user_id", "ts")

    def start(stream, out, checkpoint):
        counted = keyed.running_counts_in_window(stream, "user_id", "ts", "event_id")
        return sinks.to_files(counted, out, checkpoint, available=True)

    out = _in_drops(rows, "running-minute", _by_time(rows, F.lit(0)), start)
    return plain(spark.read.parquet(out), "ts", "window_start")


@query("""
SELECT event_id, user_id, value FROM events WHERE ts IS NOT NULL
""")
def stream_once(spark: SparkSession, data: str) -> DataFrame:
    """Every second message comes twice in its batch, every third again in a later one and every
    sixth four times; late by nine minutes at most."""
    rows = _timed(spark, data).filter("ts IS NOT NULL").select("event_id", "user_id", "value", "ts")
    number = F.col("event_id")
    twice = rows.unionByName(rows.filter(number % 2 == 0)).withColumn("delay", F.lit(0))
    again = twice.filter(number % 3 == 0).withColumn("delay", 60 + number % 480)
    sent = twice.unionByName(again)

    def start(stream, out, checkpoint):
        single = keyed.once(stream, "event_id", "ts").select("event_id", "user_id", "value")
        return sinks.to_files(single, out, checkpoint, available=True)

    return spark.read.parquet(_in_drops(sent, "once", _by_time(sent, F.col("delay")), start))


LATE = f"""
WITH {READINGS},
arrived AS (SELECT *, measurement_time AS t, event_id % 10 = 0 AS held FROM readings),
mark AS (SELECT max(t) - INTERVAL 10 MINUTE AS w FROM arrived WHERE NOT held)
"""


def _split(spark: SparkSession, data: str) -> str:
    """Every tenth event comes in the last drop, when its time may be long over."""
    rows = _timed(spark, data)
    drop = F.when(F.col("event_id") % 10 == 0, DROPS - 1).otherwise(F.col("event_id") % (DROPS - 1))

    def start(stream, out, checkpoint):
        readings = reading_columns(stream)
        return keyed.keep_late(readings, "measurement_time", 600, out, checkpoint, available=True)

    # Drops but the last hold rows of all times, so those late among them don't count here.
    return _in_drops(rows, "late-kept", drop, start)


@query(f"""
{LATE}
SELECT city_name, count(*) AS late_rows, sum(event_id)::BIGINT AS ids,
       round(max(epoch_us((SELECT w FROM mark)) - epoch_us(t)) / 1e6, 3) AS latest_by
FROM arrived WHERE held AND t <= (SELECT w FROM mark) GROUP BY 1
""")
def stream_late_rows(spark: SparkSession, data: str) -> DataFrame:
    late = keyed.read_late(spark, _split(spark, data)).filter("event_id % 10 = 0")
    return late.groupBy("city_name").agg(
        F.count(F.lit(1)).alias("late_rows"), F.sum("event_id").alias("ids"),
        F.round(F.max("late_by"), 3).alias("latest_by"),
    )


@query(f"WITH {READINGS} SELECT event_id, city_name, temperature FROM readings")
def stream_late_and_kept(spark: SparkSession, data: str) -> DataFrame:
    """Rows in time and late ones together are the input."""
    out = _split(spark, data)
    columns = ["event_id", "city_name", "temperature"]
    return keyed.read_kept(spark, out).select(columns).unionByName(keyed.read_late(spark, out).select(columns))
