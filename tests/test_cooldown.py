import subprocess
import sys
from datetime import datetime, timedelta, timezone

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablestream.operators.cooldown import _borders, _steps, cooldown

START = datetime(2024, 1, 1, tzinfo=timezone.utc)


def frame(spark, rows):
    """Rows of (key, seconds, id)."""
    made = [(k, START + timedelta(seconds=s), i) for k, s, i in rows]
    return spark.createDataFrame(made, "key string, t timestamp, id long")


def expected(rows, seconds=3600, last=None):
    """One row after the other, as the rule says."""
    sent, last = [], dict(last or {})
    for key, at, number in sorted(rows, key=lambda r: (r[1], r[2])):
        if key not in last or at - last[key] >= seconds:
            last[key] = at
            sent.append(number)
    return sorted(sent)


def emitted(df):
    return sorted(row.id for row in df.select("id").collect())


def test_gap_at_and_below_the_limit(spark):
    rows = [("a", 0, 1), ("a", 3599, 2), ("a", 3600, 3), ("b", 3599, 4), ("a", 7199, 5)]
    assert emitted(cooldown(frame(spark, rows), ["key"], "t", "id")) == [1, 3, 4]


def test_silence_counts_from_the_emitted_event(spark):
    rows = [("a", 1800 * i, i) for i in range(10)]
    assert emitted(cooldown(frame(spark, rows), ["key"], "t", "id")) == [0, 2, 4, 6, 8]


def test_equal_times_send_the_smallest_id_once(spark):
    rows = [("a", 5, 9), ("a", 5, 3), ("a", 5, 7)]
    assert emitted(cooldown(frame(spark, rows), ["key"], "t", "id")) == [3]


def test_copies_of_a_row_are_sent_once(spark):
    rows = [("a", 5, 3)] * 4 + [("a", 4000, 4)] * 2
    assert emitted(cooldown(frame(spark, rows), ["key"], "t", "id")) == [3, 4]


def test_a_hot_key_is_split_without_changing_the_result(spark):
    rows = [("hot", (i * 37) % 90_000, i) for i in range(6000)]
    rows += [("cold", i * 2000, 10_000 + i) for i in range(30)]
    df = frame(spark, rows).persist()
    want = expected(rows)
    for slices in (1, 2, 7, 60, 3600):
        assert emitted(cooldown(df, ["key"], "t", "id", slices=slices)) == want
    assert emitted(cooldown(df, ["key"], "t", "id", slice_rows=500)) == want


def test_stretches_of_time_do_not_change_the_result(spark):
    rows = [("a", (i * 7919) % 400_000, i) for i in range(1500)]
    rows += [("b", 100_000 * i + 17, 5000 + i) for i in range(20)]
    df = frame(spark, rows).persist()
    want = expected(rows)
    for slices, cells in ((1, 1), (3, 5), (7, 40), (60, 60)):
        got = cooldown(df, ["key"], "t", "id", slices=slices, stretch_cells=cells)
        assert emitted(got) == want


def test_events_close_to_one_offset_are_split_too(spark):
    rows = [("hot", 3600 * (i % 50) + (i * 13) % 100 / 1000, i) for i in range(3000)]
    df = frame(spark, rows).persist()
    want = expected(rows)
    assert emitted(cooldown(df, ["key"], "t", "id", slice_rows=200)) == want
    width = len(_borders(df.selectExpr("date_part('seconds', t) * 1.0D AS _offset"), 10))
    assert width == 9


def test_continues_from_an_earlier_batch(spark):
    first = [("a", 0, 1), ("a", 3000, 2), ("b", 100, 3)]
    second = [("a", 3599, 4), ("a", 3700, 5), ("b", 3700, 6), ("c", 10, 7)]
    last = frame(spark, [("a", 0, 0), ("b", 100, 0)]).selectExpr("key", "t AS last_sent")
    got = cooldown(frame(spark, second), ["key"], "t", "id", last_sent=last)
    assert emitted(got) == expected(second, last={"a": 0, "b": 100}) == [5, 6, 7]
    assert emitted(cooldown(frame(spark, first), ["key"], "t", "id")) == [1, 3]


def test_empty_input(spark):
    assert emitted(cooldown(frame(spark, []), ["key"], "t", "id")) == []


def test_steps_need_no_package_on_executors():
    from pyspark import cloudpickle

    steps = cloudpickle.dumps(_steps(3_600_000_000, 1, 1, ["key"]))
    load = "import sys, pyspark.cloudpickle as c; c.loads(bytes.fromhex(sys.stdin.read()))"
    done = subprocess.run(
        [sys.executable, "-c", load], input=steps.hex(), text=True, cwd="/", capture_output=True
    )
    assert done.returncode == 0, done.stderr


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.sampled_from("ab"), st.integers(0, 400)), min_size=1, max_size=60),
    st.integers(1, 50),
    st.integers(1, 12),
)
def test_any_events(spark, events, seconds, slices):
    rows = [(k, s, i) for i, (k, s) in enumerate(events)]
    got = emitted(cooldown(frame(spark, rows), ["key"], "t", "id", seconds, slices))
    assert got == expected(rows, seconds)
