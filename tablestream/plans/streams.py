"""The event table read as a stream."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import alerts, shape
from tablestream.plans.alerts import COOLDOWN_SQL, THRESHOLD_SQL, sensor_messages
from tablestream.plans.fixtures import READINGS, plain, reading_columns, rounded, table
from tablestream.plans.registry import query
from tablestream.schemas import READING_MESSAGE, SENSOR_NESTED
from tablestream.session import run_dir, use_utc
from tablestream.sources.readers import decode_json
from tablestream.streaming import pipelines, sinks, windows


STRETCHES = 3
FILE_ROWS = 1_000_000
_written: dict[tuple[str, str], tuple[str, int]] = {}


def _in_files(spark: SparkSession, data: str) -> tuple[str, int]:
    """The events in stretches of time, written one after the other in the order of ts, so that every
    stream takes several batches and carries state from one to the next; and the files of a stretch,
    the same for all. Rows without a ts are in the first stretch."""
    known = (spark.sparkContext.applicationId, data)
    if known not in _written:
        rows = table(spark, data, "events")
        micros = F.unix_micros(F.col("ts").cast("timestamp"))
        cuts = [i / STRETCHES for i in range(1, STRETCHES)]
        borders = rows.agg(F.percentile_approx(micros, cuts)).first()[0] or []
        stretch = sum((F.coalesce(micros >= b, F.lit(False)).cast("int") for b in borders), F.lit(0))
        sizes = dict(rows.groupBy(stretch).count().collect())  # at most one row a stretch
        files = max(1, -(-max(sizes.values(), default=0) // FILE_ROWS))
        folder = run_dir(spark, "events")
        first = 0
        for last in range(len(borders) + 1):
            held = sum(sizes.get(k, 0) for k in range(first, last + 1))
            # A stretch with too few rows for its files goes with the next.
            if files > 1 and held < 100 * files and last < len(borders):
                continue
            if files > 1 and sum(sizes.get(k, 0) for k in range(last + 1, len(borders) + 1)) < 100 * files:
                last = len(borders)
            rows.filter(stretch.between(first, last)).repartition(files).write.mode("append").parquet(folder)
            first = last + 1
            if first > len(borders):
                break
        _written[known] = folder, files
    return _written[known]


def _events(spark: SparkSession, data: str) -> DataFrame:
    """Watermarks need timestamps with a zone."""
    folder, files = _in_files(use_utc(spark), data)
    stream = pipelines.table_stream(spark, folder, files_per_batch=files)
    return stream.withColumn("ts", F.col("ts").cast("timestamp"))


def _finished(spark: SparkSession, name: str, start: Callable[[str, str], object]) -> str:
    """Run a stream until its input is used up; returns the folder of its output."""
    root = run_dir(spark, name)
    start(f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


MEANS = ["avg_temperature", "avg_humidity", "avg_pressure"]
WINDOW = """city_name, date_trunc('hour', t) AS window_start,
       date_trunc('hour', t) + INTERVAL 1 HOUR AS window_end"""
SIX = """round(round(avg(temperature), 9), 6) AS avg_temperature, max(temperature) AS max_temperature,
       min(temperature) AS min_temperature, round(round(avg(humidity), 9), 6) AS avg_humidity,
       round(round(avg(pressure), 9), 6) AS avg_pressure"""


def _windows_out(df: DataFrame, *more: str) -> DataFrame:
    return plain(rounded(df, *MEANS, *more), "window_start", "window_end")


@query(f"""
WITH {READINGS}, timed AS (SELECT *, measurement_time AS t FROM readings)
SELECT {WINDOW}, {SIX}, round(round(avg(wind_speed), 9), 6) AS avg_wind_speed
FROM timed GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(t) - INTERVAL 10 MINUTE FROM timed)
""")
def stream_tumbling_hour(spark: SparkSession, data: str) -> DataFrame:
    rows = reading_columns(_events(spark, data))
    hours = windows.hourly_readings(rows, "city_name", "measurement_time")

    def start(out, checkpoint):
        return sinks.to_files(hours, out, checkpoint, available=True)

    out = _finished(spark, "tumbling", start)
    return _windows_out(spark.read.schema(hours.schema).parquet(out), "avg_wind_speed")


@query(f"""
WITH {READINGS}, timed AS (SELECT *, measurement_time AS t FROM readings)
SELECT {WINDOW}, {SIX}, round(round(avg(wind_speed), 9), 6) AS avg_wind_speed
FROM timed GROUP BY 1, 2, 3
""")
def stream_hour_updates(spark: SparkSession, data: str) -> DataFrame:
    rows = reading_columns(_events(spark, data))
    hours = windows.hourly_readings(rows, "city_name", "measurement_time")

    def start(out, checkpoint):
        return sinks.to_update_log(hours, out, checkpoint, available=True)

    out = _finished(spark, "updates", start)
    keys = ["city_name", "window_start", "window_end"]
    return _windows_out(sinks.read_updates(spark, out, keys), "avg_wind_speed")


@query(f"""
WITH {READINGS},
timed AS (
  SELECT city_name, measurement_time + INTERVAL 1 SECOND * (event_id % 5400) AS t,
         CASE WHEN event_id % 3 <> 0 THEN temperature END AS temperature, humidity, pressure
  FROM readings)
SELECT {WINDOW}, {SIX} FROM timed GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(t) FROM timed) AND count(temperature) > 0
""")
def stream_arrival_hour(spark: SparkSession, data: str) -> DataFrame:
    rows = reading_columns(_events(spark, data))
    delay = F.make_dt_interval(secs=F.col("event_id") % 5400)
    arrived = rows.withColumns(
        {
            "arrival": F.col("measurement_time") + delay,
            "temperature": F.when(F.col("event_id") % 3 != 0, F.col("temperature")),
        }
    )
    hours = windows.arrival_hours(arrived, "city_name")

    def start(out, checkpoint):
        return sinks.to_files(hours, out, checkpoint, available=True)

    out = _finished(spark, "arrival", start)
    return _windows_out(spark.read.schema(hours.schema).parquet(out))


@query("""
SELECT user_id, date_trunc('minute', ts) AS window_start,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS window_end, count(*) AS events
FROM events GROUP BY 1, 2, 3
""")
def stream_minute_count(spark: SparkSession, data: str) -> DataFrame:
    counts = windows.minute_counts(_events(spark, data), "user_id", "ts")

    def start(out, checkpoint):
        return sinks.to_update_log(counts, out, checkpoint, available=True)

    out = _finished(spark, "minutes", start)
    keys = ["user_id", "window_start", "window_end"]
    return plain(sinks.read_updates(spark, out, keys), "window_start", "window_end")


@query("SELECT user_id, count(*) AS events FROM events GROUP BY 1")
def stream_running_count(spark: SparkSession, data: str) -> DataFrame:
    counts = windows.running_counts(_events(spark, data), "user_id")

    def start(out, checkpoint):
        return sinks.to_complete_table(counts, out, checkpoint, available=True)

    return sinks.read_complete(spark, _finished(spark, "running", start))


@query(COOLDOWN_SQL)
def stream_cooldown(spark: SparkSession, data: str) -> DataFrame:
    rows = reading_columns(_events(spark, data).filter("ts IS NOT NULL"), "timestamp")

    def start(out, checkpoint):
        return pipelines.live_alerts(rows, out, checkpoint, "event_id", available=True)

    out = _finished(spark, "live-alerts", start)
    return plain(spark.read.parquet(f"{out}/alerts").drop("batch"), "timestamp")


@query(f"""
WITH {READINGS}
SELECT 'reading' AS sink, event_id, city_name, temperature, NULL AS alert FROM readings
UNION ALL
SELECT 'alert', event_id, city_name, temperature,
       CASE WHEN temperature > 35 THEN 'EXTREME_HEAT' WHEN temperature < 5 THEN 'EXTREME_COLD'
            WHEN wind_speed > 15 THEN 'HIGH_WIND' ELSE 'HIGH_HUMIDITY' END
FROM readings
WHERE temperature > 35 OR temperature < 5 OR wind_speed > 15 OR humidity > 90
""")
def stream_fanout(spark: SparkSession, data: str) -> DataFrame:
    rows = reading_columns(_events(spark, data))
    columns = ["event_id", "city_name", "temperature"]

    def start(out, checkpoint):
        raw = sinks.batch_files(f"{out}/readings", lambda batch: batch.select(columns))
        flagged = sinks.batch_files(
            f"{out}/alerts",
            lambda batch: batch.select(*columns, alerts.alert_flag().alias("alert")).filter(
                "alert IS NOT NULL"
            ),
        )
        return sinks.fan_out(rows, [raw, flagged], checkpoint, available=True)

    out = _finished(spark, "fanout", start)
    raw = spark.read.parquet(f"{out}/readings").select(F.lit("reading").alias("sink"), *columns)
    found = spark.read.parquet(f"{out}/alerts").select(
        F.lit("alert").alias("sink"), *columns, "alert"
    )
    return raw.unionByName(found, allowMissingColumns=True)


@query("""
SELECT 'first' AS reader, event_id, event_type FROM events
UNION ALL SELECT 'second', event_id, event_type FROM events
""")
def stream_two_readers(spark: SparkSession, data: str) -> DataFrame:
    rows = _events(spark, data).select("event_id", "event_type")
    parts = []
    for name in ("first", "second"):

        def start(out, checkpoint):
            return sinks.to_files(rows, out, checkpoint, available=True)

        out = _finished(spark, f"reader-{name}", start)
        parts.append(spark.read.schema(rows.schema).parquet(out).withColumn("reader", F.lit(name)))
    return parts[0].unionByName(parts[1])


@query(f"""
WITH {READINGS},
arrived AS (SELECT *, measurement_time AS t, event_id % 10 = 0 AS late FROM readings),
mark AS (SELECT max(t) - INTERVAL 10 MINUTE AS w FROM arrived WHERE NOT late),
kept AS (
  SELECT * FROM arrived
  WHERE NOT late OR date_trunc('hour', t) + INTERVAL 1 HOUR > (SELECT w FROM mark))
SELECT {WINDOW}, {SIX}, round(round(avg(wind_speed), 9), 6) AS avg_wind_speed
FROM kept GROUP BY 1, 2, 3
HAVING window_end <= (SELECT max(t) - INTERVAL 10 MINUTE FROM arrived)
""")
def stream_late(spark: SparkSession, data: str) -> DataFrame:
    """Every tenth event comes only after all others have been read; the query is stopped and
    started again in between, so its watermark comes back from the checkpoint."""
    root = run_dir(use_utc(spark), "late")
    events = table(spark, data, "events")
    rows = events.withColumn("ts", F.col("ts").cast("timestamp"))
    stream = spark.readStream.schema(rows.schema).parquet(f"{root}/in/*")
    hours = windows.hourly_readings(reading_columns(stream), "city_name", "measurement_time")
    for drop, late in (("first", False), ("late", True)):
        part = rows.filter((F.col("event_id") % 10 == 0) == late)
        part.write.parquet(f"{root}/in/{drop}")
        done = sinks.to_files(hours, f"{root}/out", f"{root}/checkpoint", available=True)
        done.awaitTermination()
    return _windows_out(spark.read.schema(hours.schema).parquet(f"{root}/out"), "avg_wind_speed")


@query("SELECT event_id, value * 2 AS doubled FROM events")
def stream_append_csv(spark: SparkSession, data: str) -> DataFrame:
    rows = shape.scaled(_events(spark, data), "value", "doubled", 2.0)
    rows = rows.select("event_id", "doubled")

    def start(out, checkpoint):
        return sinks.to_files(rows, out, checkpoint, "csv", available=True)

    out = _finished(spark, "csv", start)
    return spark.read.schema(rows.schema).option("header", True).csv(out)


@query(f"""
WITH {READINGS}
SELECT city_name, temperature, humidity, pressure, wind_speed,
       measurement_time AS "timestamp", strftime(measurement_time, '%Y-%m-%d') AS date
FROM readings
""")
def stream_normalise(spark: SparkSession, data: str) -> DataFrame:
    """Messages as JSON text, normalised and landed by day."""
    flat = reading_columns(_events(spark, data), "ts")
    text = F.to_json(
        F.struct(
            "city_name", "temperature", "humidity", "pressure", "wind_speed",
            F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("timestamp"),
        )
    )
    messages = flat.select(text.alias("value"))
    rows = shape.normalise_reading(decode_json(messages, READING_MESSAGE)).select(
        "city_name", "temperature", "humidity", "pressure", "wind_speed", "timestamp"
    )

    def start(out, checkpoint):
        return sinks.to_landing(rows, out, checkpoint, "timestamp", available=True)

    out = _finished(spark, "landing", start)
    schema = rows.schema.add("date", "string")
    return plain(spark.read.schema(schema).json(out), "timestamp")


@query(THRESHOLD_SQL)
def stream_threshold_topic(spark: SparkSession, data: str) -> DataFrame:
    sent = sensor_messages(_events(spark, data)).select(F.to_json(F.struct("*")).alias("value"))
    found = alerts.threshold_alerts(decode_json(sent, SENSOR_NESTED))

    def start(out, checkpoint):
        return sinks.to_topic(found, checkpoint, "text", {"path": out}, available=True)

    return spark.read.text(_finished(spark, "topic", start))
