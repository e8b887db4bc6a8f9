"""Streams fed by files dropped one after the other, against the batch form of each function."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_cooldown import expected

from tablestream import schemas
from tablestream.operators import alerts, shape
from tablestream.operators.quality import split_undecodable
from tablestream.session import CLUSTER_SETTINGS
from tablestream.sources import readers
from tablestream.streaming import pipelines, sinks, windows

START = datetime(2024, 1, 1)
READING = ("event_id long, city_name string, timestamp timestamp, temperature double,"
           " humidity double, wind_speed double, pressure double")


def reading(number, minutes, temperature=20.0, city="a", humidity=50.0):
    return (number, city, START + timedelta(minutes=minutes), temperature, humidity, 1.0, 1000.0)


class Drops:
    """A folder that gets one file per call."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.count = spark, folder, schema, 0

    def add(self, *rows):
        self.count += 1
        df = self.spark.createDataFrame(list(rows), self.schema).coalesce(1)
        df.write.parquet(f"{self.folder}/in/{self.count:03d}")

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.folder}/in/*")

    def table(self):
        return self.spark.read.schema(self.schema).parquet(f"{self.folder}/in/*")


@pytest.fixture
def drops(spark, tmp_path):
    return Drops(spark, str(tmp_path), READING)


def run(query):
    query.awaitTermination()


def hours_of(df):
    return sorted(
        (r.city_name, r.window_start, r.avg_temperature, r.max_temperature)
        for r in df.select("city_name", "window_start", "avg_temperature",
                           "max_temperature").collect()
    )


def test_hourly_windows_equal_batch(spark, drops, tmp_path):
    drops.add(reading(1, 0, 10.0), reading(2, 59, 20.0), reading(3, 60, 30.0))
    drops.add(reading(4, 61, 40.0), reading(5, 130, 5.0, "b"))
    drops.add(reading(6, 300, 1.0))
    hours = windows.hourly_readings(drops.stream(), "city_name", "timestamp")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    run(sinks.to_files(hours, out, checkpoint, available=True))
    batch = windows.hourly_readings(drops.table(), "city_name", "timestamp")
    closed = batch.filter(F.col("window_end") <= F.lit(START + timedelta(minutes=290)))
    got = hours_of(spark.read.schema(hours.schema).parquet(out))
    assert got == hours_of(closed) and len(got) == 3
    # The edge row of 01:00 belongs to the second hour.
    assert ("a", START + timedelta(hours=1), 35.0, 40.0) in got


def test_late_rows_and_restart(spark, drops, tmp_path):
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def go():
        hours = windows.hourly_readings(drops.stream(), "city_name", "timestamp")
        run(sinks.to_files(hours, out, checkpoint, available=True))
        return hours_of(spark.read.schema(hours.schema).parquet(out))

    drops.add(reading(1, 5, 10.0), reading(2, 200, 10.0))
    first = go()
    assert first == [("a", START, 10.0, 10.0)]
    drops.add(reading(3, 6, 99.0), reading(4, 185, 30.0))
    drops.add(reading(5, 400, 0.0))
    assert go() == [("a", START, 10.0, 10.0), ("a", START + timedelta(hours=3), 20.0, 30.0)]


def test_arrival_hours_skip_hours_without_temperature(spark, drops, tmp_path):
    drops.add(reading(1, 0, None), reading(2, 70, 10.0, humidity=None), reading(3, 80, None))
    drops.add(reading(4, 200, 1.0))
    rows = drops.stream().withColumnRenamed("timestamp", "arrival")
    hours = windows.arrival_hours(rows, "city_name")
    out = str(tmp_path / "out")
    run(sinks.to_files(hours, out, str(tmp_path / "cp"), available=True))
    (only,) = spark.read.schema(hours.schema).parquet(out).collect()
    assert (only.window_start.hour, only.avg_temperature, only.avg_humidity) == (1, 10.0, 50.0)


def test_running_and_minute_counts(spark, drops, tmp_path):
    drops.add(reading(1, 0), reading(2, 0, city="b"))
    drops.add(reading(3, 0), reading(4, 1))
    total = windows.running_counts(drops.stream(), "city_name")
    run(sinks.to_complete_table(total, str(tmp_path / "c"), str(tmp_path / "cc"), True))
    got = sinks.read_complete(spark, str(tmp_path / "c")).collect()
    assert {r.city_name: r.events for r in got} == {"a": 3, "b": 1}
    minutes = windows.minute_counts(drops.stream(), "city_name", "timestamp")
    run(sinks.to_update_log(minutes, str(tmp_path / "m"), str(tmp_path / "mc"), True))
    keys = ["city_name", "window_start", "window_end"]
    rows = sinks.read_updates(spark, str(tmp_path / "m"), keys).collect()
    assert {(r.city_name, r.window_start.minute): r.events for r in rows} == {
        ("a", 0): 2, ("a", 1): 1, ("b", 0): 1,
    }


def test_live_alerts_over_batches(spark, drops, tmp_path):
    batches = [
        [reading(1, 0, 36.0), reading(2, 30, 37.0), reading(3, 0, 40.0, "b")],
        [reading(4, 59, 36.0), reading(5, 60, 36.0), reading(6, 61, 20.0, "b")],
        [reading(7, 119, 36.0), reading(8, 121, 36.0), reading(9, 10, 3.0, "b")],
    ]
    for rows in batches:
        drops.add(*rows)
    out = str(tmp_path / "out")
    topic = sinks.batch_files(
        str(tmp_path / "topic"), lambda b: b.select(F.to_json(F.struct("*")).alias("value")), "text"
    )
    run(pipelines.live_alerts(drops.stream(), out, str(tmp_path / "cp"), "event_id",
                              available=True, publish=topic))
    assert spark.read.text(str(tmp_path / "topic")).count() == 5
    sent = spark.read.parquet(f"{out}/alerts")
    assert sent.select("batch").distinct().count() == 3
    hot = [("a", r[2].minute * 60 + r[2].hour * 3600, r[0])
           for rows in batches for r in rows if r[1] == "a" and r[3] > 35]
    got = sorted(r.event_id for r in sent.filter("alert_type = 'HIGH_TEMPERATURE'").collect())
    assert got == sorted(expected(hot) + [3])
    assert [r.event_id for r in sent.filter("alert_type = 'LOW_TEMPERATURE'").collect()] == [9]


def test_messages_to_landing_and_dead_letters(spark, tmp_path):
    folder = tmp_path / "topic"
    folder.mkdir()
    lines = [
        {"city_name": "x", "temperature": 1.0, "timestamp": "2024-01-01T10:00:00"},
        {"city_name": "y", "main": {"temp": 2.0}, "dt": 1704153600},
        {"temperature": 3.0},
    ]
    text = "\n".join([*map(json.dumps, lines), "{broken"])
    (folder / "m.txt").write_text(text)
    stream = readers.read_event_stream(
        spark, schemas.READING_MESSAGE, "text", options={"path": str(folder)}
    )
    rows = shape.normalise_reading(stream)
    out = str(tmp_path / "landing")
    run(sinks.to_landing(rows, out, str(tmp_path / "cp"), "timestamp", available=True))
    got = spark.read.json(out).collect()
    assert sorted((r.city_name, str(r.date)) for r in got) == [
        ("x", "2024-01-01"), ("y", "2024-01-02"),
    ]
    raw = spark.readStream.text(str(folder))
    good, dead = split_undecodable(raw, "city_name string, temperature double")
    run(sinks.to_files(dead, str(tmp_path / "dead"), str(tmp_path / "dcp"), available=True))
    assert [r.dead_letter for r in spark.read.parquet(str(tmp_path / "dead")).collect()] == [
        "{broken"
    ]
    run(sinks.to_files(good, str(tmp_path / "good"), str(tmp_path / "gcp"), available=True))
    assert spark.read.parquet(str(tmp_path / "good")).count() == 3


def test_fan_out_reads_once_and_serves_all(spark, drops, tmp_path):
    drops.add(reading(1, 0, 36.0), reading(2, 1))
    raw = sinks.batch_files(str(tmp_path / "raw"), lambda b: b)
    topic = sinks.batch_files(
        str(tmp_path / "topic"),
        lambda b: b.select(alerts.alert_flag().alias("value")).filter("value IS NOT NULL"), "text",
    )
    query = sinks.fan_out(drops.stream(), [raw, topic], str(tmp_path / "cp"), available=True)
    run(query)
    assert sum(p["numInputRows"] for p in query.recentProgress) == 2
    assert spark.read.parquet(str(tmp_path / "raw")).count() == 2
    assert [r.value for r in spark.read.text(str(tmp_path / "topic")).collect()] == ["EXTREME_HEAT"]


def test_topic_messages_and_csv(spark, drops, tmp_path):
    drops.add(reading(1, 0))
    rows = drops.stream().select("event_id", "timestamp")
    path = str(tmp_path / "t")
    run(sinks.to_topic(rows, str(tmp_path / "tc"), "text", {"path": path}, available=True))
    (line,) = spark.read.text(path).collect()
    assert json.loads(line.value)["event_id"] == 1
    out = str(tmp_path / "csv")
    doubled = shape.scaled(drops.stream(), "temperature", "doubled", 2).select("doubled")
    run(sinks.to_files(doubled, out, str(tmp_path / "cc"), "csv", available=True))
    drops.add(reading(2, 1, 21.0))
    run(sinks.to_files(doubled, out, str(tmp_path / "cc"), "csv", available=True))
    got = spark.read.schema(doubled.schema).option("header", True).csv(out)
    assert sorted(r.doubled for r in got.collect()) == [40.0, 42.0]


def test_relational_rows_are_written_once(spark, tmp_path, monkeypatch):
    path, calls = str(tmp_path / "table"), []
    spark.createDataFrame([("old",)], "message_id string").write.parquet(path)

    def write(df, url, table, mode, batch_size):
        calls.append((table, batch_size))
        df.write.mode(mode).parquet(path)
        if len(calls) == 2:
            raise OSError("lost the connection after writing")

    def known(session, url, table, key):
        calls.append("compared")
        return session.createDataFrame(session.read.parquet(path).select(key).collect())

    monkeypatch.setattr(sinks, "write_jdbc", write)
    monkeypatch.setattr(sinks, "_known_keys", known)
    send = sinks.jdbc_batches("jdbc:x", "events", "message_id", retries=1)

    def batch(*keys):
        return spark.createDataFrame([(k,) for k in keys], "message_id string")

    send(batch("old", "a", "a"), 0)
    send(batch("b"), 1)
    send(batch("c"), 2)
    assert sorted(r.message_id for r in spark.read.parquet(path).collect()) == ["a", "b", "c", "old"]
    assert calls == ["compared", ("events", 200), "compared", ("events", 200), ("events", 200),
                     ("events", 200)]


def test_cluster_settings_run_windows(spark, drops, tmp_path):
    names = [n for n in CLUSTER_SETTINGS if "streaming" in n]
    drops.add(reading(1, 0), reading(2, 1))
    try:
        for name in names:
            spark.conf.set(name, CLUSTER_SETTINGS[name])
        counts = windows.minute_counts(drops.stream(), "city_name", "timestamp")
        run(sinks.to_update_log(counts, str(tmp_path / "m"), str(tmp_path / "mc"), True))
    finally:
        for name in names:
            spark.conf.unset(name)
    assert spark.read.parquet(str(tmp_path / "m")).count() == 2


def test_throughput_and_recent(spark):
    rows = [(START + timedelta(seconds=s),) for s in (0, 1, 4, 5, 100)]
    df = spark.createDataFrame(rows, "t timestamp")
    bins = {r.bin_start.second + 60 * r.bin_start.minute: r.events_per_second
            for r in windows.throughput(df, "t").collect()}
    assert bins == {0: 0.6, 5: 0.2, 100: 0.2}
    assert windows.recent_events(df, "t", F.lit(START + timedelta(seconds=65))).first().events == 2


def test_batch_times_keep_the_newest():
    times = pipelines.BatchTimes(keep=2)
    assert times.mean is None
    times.times.extend([1, 2, 4])
    assert times.mean == 3


@pytest.mark.parametrize("file_rows", [1_000_000, 300])
def test_streams_read_events_without_a_time(spark, tmp_path, monkeypatch, file_rows):
    from tablestream.plans import streams

    monkeypatch.setattr(streams, "FILE_ROWS", file_rows)
    schema = "event_id long, ts timestamp, event_type string, user_id long, value double, props string"
    rows = [(k, START + timedelta(minutes=k) if k % 7 else None, "x", k % 5, 1.0, "{}") for k in range(7000)]
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "events.parquet"))
    folder, files = streams._in_files(spark, str(tmp_path))
    per_stretch = spark.read.parquet(folder).inputFiles()
    assert len(per_stretch) == 3 * files and (files > 1) == (file_rows == 300)
    counts = {r.user_id: r.events for r in streams.stream_running_count(spark, str(tmp_path)).collect()}
    assert counts == {k: 1400 for k in range(5)}
    assert streams.stream_append_csv(spark, str(tmp_path)).count() == len(rows)
    minutes = streams.stream_minute_count(spark, str(tmp_path))
    assert minutes.filter("window_start IS NOT NULL").agg(F.sum("events")).first()[0] == 6000
