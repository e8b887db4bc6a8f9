"""Streams with keyed state: batches cut anyhow, restarts, expiry of state, late rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tablestream.operators.cooldown import cooldown
from tablestream.session import run_dir
from tablestream.streaming import keyed, sinks

START = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
SCHEMA = "id long, key string, ts timestamp, note string"


def some_events(seed=1, n=400):
    rnd = random.Random(seed)
    rows = []
    for k in range(n):
        key = rnd.choice(["hot", "hot", "hot", "a", "b", None])
        rows.append((k, key, START + dt.timedelta(seconds=rnd.randrange(0, 40_000), microseconds=rnd.randrange(3)), f"é{k}"))
    rows += [(900, "once", START, None), (901, "once", START, "later"), (902, "edge", START, "x"),
             (903, "edge", START + dt.timedelta(hours=1), "y"), (904, "edge", START + dt.timedelta(hours=2, microseconds=-1), "z")]
    return rows


def fed(spark, drops, run):
    """The output of a stream that gets its input drop by drop and is started anew for each."""
    root = run_dir(spark, "fed")
    for rows in drops:
        spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(SCHEMA).parquet(f"{root}/in")
        run(stream, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return f"{root}/out"


def cut(rows, parts, seed):
    """Rows in drops, out of order by less than ten minutes."""
    rnd = random.Random(seed)
    rows = sorted(rows, key=lambda r: r[2] + dt.timedelta(seconds=rnd.randrange(0, 590)))
    at = sorted(rnd.randrange(len(rows)) for _ in range(parts - 1))
    return [rows[a:b] for a, b in zip([0, *at], [*at, len(rows)], strict=True)]


@pytest.mark.parametrize(("parts", "seed"), [(1, 1), (4, 2), (7, 3)])
def test_silence_does_not_depend_on_batches(spark, parts, seed):
    rows = some_events()
    # A last event moves the watermark past all others.
    rows.append((999, "end", START + dt.timedelta(days=2), "end"))

    def run(stream, out, checkpoint):
        sent = keyed.cooled_down(stream, ["key"], "ts", "id")
        return sinks.to_files(sent, out, checkpoint, available=True)

    found = spark.read.parquet(fed(spark, cut(rows, parts, seed), run)).collect()
    batch = cooldown(spark.createDataFrame(rows, SCHEMA), ["key"], "ts", "id")
    assert {tuple(r) for r in found if r.key != "end"} == {tuple(r) for r in batch.collect() if r.key != "end"}
    assert len(found) == len({r.id for r in found})
    # A null key is a key.
    times = sorted(r.ts for r in found if r.key is None)
    assert times
    assert all(b - a >= dt.timedelta(hours=1) for a, b in zip(times, times[1:], strict=False))


def test_state_of_silent_keys_is_dropped(spark):
    rows = [(k, f"k{k}", START + dt.timedelta(minutes=k), "") for k in range(50)]
    late = [(100, "last", START + dt.timedelta(days=1), "")]
    sizes = []

    def run(stream, out, checkpoint):
        query = sinks.to_files(keyed.cooled_down(stream, ["key"], "ts", "id"), out, checkpoint, available=True)
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
        return query

    fed(spark, [rows, late], run)
    assert sizes[0] == 50
    assert sizes[1] == 1


def test_counts_continue_and_windows_expire(spark):
    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    first = [(1, "a", at(5), ""), (2, "a", at(50), ""), (3, "b", at(50), ""), (4, None, at(7), "")]
    second = [(5, "a", at(10), ""), (6, "a", at(61), ""), (7, "a", at(10), "")]
    third = [(8, "a", at(100_000), "")]
    fourth = [(9, "a", at(11), "")]  # its window is over and gone
    sizes = []

    def run(stream, out, checkpoint):
        counted = keyed.running_counts_in_window(stream, "key", "ts", "id")
        query = sinks.to_files(counted, out, checkpoint, available=True)
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
        return query

    found = spark.read.parquet(fed(spark, [first, second, third, fourth], run)).collect()
    assert {(r.id, r.events_so_far) for r in found} == {(1, 1), (2, 2), (3, 1), (4, 1), (5, 3), (7, 4), (6, 1), (8, 1)}
    assert sizes == [3, 3, 1, 1]


def test_state_of_counts_does_not_grow_with_keys(spark):
    rows = [(k, f"k{k}", START + dt.timedelta(seconds=k % 50), "") for k in range(1200)]
    again = [(k + 1200, key, ts + dt.timedelta(seconds=5), "") for k, key, ts, _ in rows]
    sizes = []

    def run(stream, out, checkpoint):
        counted = keyed.running_counts_in_window(stream, "key", "ts", "id")
        query = sinks.to_files(counted, out, checkpoint, available=True)
        query.awaitTermination()
        sizes.append(query.lastProgress.stateOperators[0].numRowsTotal)
        return query

    found = spark.read.parquet(fed(spark, [rows, again], run)).collect()
    assert {(r.id, r.key, r.events_so_far) for r in found} == {
        (k, key, 1 + (k >= 1200 and (ts - START).seconds < 60)) for k, key, ts, _ in rows + again
    }
    assert max(sizes) <= 1024


@pytest.mark.parametrize(("kind", "slots"), [("long", 1), ("string", 7), ("double", 7), ("timestamp", 1)])
def test_keys_that_share_a_state_are_counted_apart(spark, kind, slots):
    rnd = random.Random(slots)
    big = 2**53  # the next whole number is no float
    rows = [(rnd.choice([None, *range(big, big + 500)]), rnd.choice([None, 0, 1, 2, 3]),
             START + dt.timedelta(seconds=rnd.randrange(0, 9000), microseconds=rnd.randrange(2))) for _ in range(400)]
    rows += [(None, 1, START), (big + 1, 1, START), (big, 1, START), (5, None, START), (6, None, START)]
    rows.sort(key=lambda r: r[2])
    drops = [rows[:150], rows[150:151], rows[151:]]
    key = {"long": f"{big} + k", "timestamp": "timestamp_micros(k * 3600000000 + 1)"}.get(kind, f"cast(k as {kind})")
    root = run_dir(spark, "shared")
    for drop in drops:
        made = spark.createDataFrame(drop, "id long, k long, ts timestamp").selectExpr("id", f"{key} AS key", "ts")
        made.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = spark.readStream.schema(made.schema).parquet(f"{root}/in")
        counted = keyed.running_counts_in_window(stream, "key", "ts", "id", slots=slots)
        assert counted.dtypes[:3] == made.dtypes
        sinks.to_files(counted, f"{root}/out", f"{root}/checkpoint", available=True).awaitTermination()
    all_keys = spark.createDataFrame([(k,) for k in [None, 0, 1, 2, 3]], "k long").selectExpr("k", f"{key} AS key")
    named = {r.k: r.key for r in all_keys.collect()}
    expected, seen = [], {}
    for drop in drops:
        for i, k, ts in sorted(drop, key=lambda r: (r[2], r[0] is None, r[0] or 0)):
            window = ts.replace(second=0, microsecond=0)
            seen[k, window] = seen.get((k, window), 0) + 1
            expected.append((i, named[k], ts.replace(tzinfo=None), window.replace(tzinfo=None), seen[k, window]))
    found = spark.read.parquet(f"{root}/out").selectExpr(
        "id", "key", "cast(ts as timestamp_ntz)", "cast(window_start as timestamp_ntz)", "events_so_far"
    )
    assert sorted(map(tuple, found.collect()), key=str) == sorted(expected, key=str)


def test_messages_come_once(spark):
    rows = some_events(5, 200)
    again = [*rows[::2], *rows[::3]]

    def run(stream, out, checkpoint):
        return sinks.to_files(keyed.once(stream, "id", "ts", "2 days"), out, checkpoint, available=True)

    out = spark.read.parquet(fed(spark, [rows, again, rows[::5]], run))
    assert sorted(r.id for r in out.collect()) == sorted(r[0] for r in rows)


def test_late_rows_are_kept_apart_and_batches_may_repeat(spark):
    def at(seconds):
        return START + dt.timedelta(seconds=seconds)

    drops = [
        [(1, "a", at(0), ""), (2, "a", at(1000), ""), (3, "a", None, "")],
        [(4, "a", at(400), ""), (5, "a", at(401), ""), (6, "a", at(0), ""), (7, "b", at(2000), "")],
        [(8, "a", at(1400), ""), (9, "a", None, "")],
    ]
    out = fed(spark, drops, lambda s, o, c: keyed.keep_late(s, "ts", 600, o, c, available=True))
    assert {r.id for r in keyed.read_kept(spark, out).collect()} == {1, 2, 3, 5, 7, 9}
    assert {(r.id, r.late_by) for r in keyed.read_late(spark, out).collect()} == {(4, 0.0), (6, 400.0), (8, 0.0)}
    # A batch that was cut short has no mark and counts for nothing.
    spark.createDataFrame([(10, "a", at(5), "")], SCHEMA).write.parquet(f"{out}/kept/batch=77")
    assert keyed.read_kept(spark, out).filter(F.col("id") == 10).isEmpty()
