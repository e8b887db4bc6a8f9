"""Tables that are changed in part: buckets, daily states, the ledger, layout, schemas, variants."""

import datetime as dt
import math
import os
import random
from collections import Counter
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as t

from tablestream.functions import resolution, variants
from tablestream.operators import changes, daily, ranking
from tablestream.sources import ledger, readers, writers


def files_of(path):
    return {str(p): (p.stat().st_mtime_ns, p.stat().st_size) for p in Path(path).rglob("*.parquet")}


LOG = "id long, seq long, op string, name string"


def test_changes_rewrite_only_touched_buckets(spark, tmp_path):
    target = spark.createDataFrame([(k, f"n{k}") for k in range(200)] + [(None, "null")], "id long, name string")
    path = str(tmp_path / "table")
    changes.create_bucketed(target, path, "id", 16)
    before = files_of(path)
    log = [(3, 1, "U", "x"), (3, 2, "D", None), (900, 3, "I", "new"), (None, 4, "U", "y"), (901, 5, "U", "z")]
    log = spark.createDataFrame(log, LOG)
    touched = {r[0] for r in changes.with_bucket(log, "id", 16).select("bucket").distinct().collect()}
    rejected = changes.apply_to_buckets(spark, path, log, "id", "seq", 16, str(tmp_path / "s1"))
    assert [(r.id, r.reason) for r in rejected.collect()] == [(901, "missing")]
    after = files_of(path)
    for name, stamp in before.items():
        bucket = int(name.split("bucket=")[1].split("/")[0])
        assert (after.get(name) == stamp) == (bucket not in touched)
    state, _ = changes.apply_changes(target, log, "id", "seq")
    found = Counter(tuple(r) for r in spark.read.parquet(path).select("id", "name").collect())
    assert found == Counter(tuple(r) for r in state.collect())


def test_a_batch_of_changes_may_stop_and_repeat(spark, tmp_path, monkeypatch):
    path, staged = str(tmp_path / "table"), str(tmp_path / "staged")
    changes.create_bucketed(spark.createDataFrame([(k, "old") for k in range(50)], "id long, name string"), path, "id", 8)
    log = spark.createDataFrame([(k, k, "D", None) for k in range(25)] + [(70, 99, "I", "new")], LOG)

    def stop(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(changes, "write_partitions", stop)
        with pytest.raises(RuntimeError):
            changes.apply_to_buckets(spark, path, log, "id", "seq", 8, staged)
    for _ in range(2):
        rejected = changes.apply_to_buckets(spark, path, log, "id", "seq", 8, staged)
        assert rejected.isEmpty()
    assert {tuple(r) for r in spark.read.parquet(path).select("id", "name").collect()} == {
        *((k, "old") for k in range(25, 50)), (70, "new")
    }


def test_buckets_may_become_empty(spark, tmp_path):
    path = str(tmp_path / "table")
    changes.create_bucketed(spark.createDataFrame([(k, "x") for k in range(6)], "id long, name string"), path, "id", 64)
    log = spark.createDataFrame([(k, k, "D", None) for k in range(5)], LOG)
    changes.apply_to_buckets(spark, path, log, "id", "seq", 64, str(tmp_path / "s"))
    assert [r.id for r in spark.read.parquet(path).collect()] == [5]
    none = spark.createDataFrame([], LOG)
    before = files_of(path)
    assert changes.apply_to_buckets(spark, path, none, "id", "seq", 64, str(tmp_path / "s2")).isEmpty()
    assert files_of(path) == before


def test_snapshots_with_null_and_repeated_keys(spark, tmp_path):
    def at(day):
        return dt.date(2024, 1, day)

    schema = "id long, v string, at date"
    first = spark.createDataFrame([(1, "a", at(1)), (1, "b", at(2)), (None, "n", at(1)), (2, "c", at(1))], schema)
    history = changes.snapshot(None, first, "id", "at")
    assert {(r.id, r.v) for r in history.collect()} == {(1, "b"), (None, "n"), (2, "c")}
    second = spark.createDataFrame([(None, "m", at(5)), (None, "l", at(4)), (1, "b", at(2)), (1, "d", at(6))], schema)
    path = str(tmp_path / "history")
    changes.create_bucketed(history, path, "id", 4)
    for k in range(3):
        changes.snapshot_to_buckets(spark, path, second, "id", "at", 4, str(tmp_path / f"s{k}"))
    found = Counter((r.id, r.v, r.valid_from, r.valid_to) for r in spark.read.parquet(path).collect())
    assert found == Counter([
        (1, "b", at(2), at(6)), (1, "d", at(6), None), (None, "n", at(1), at(5)), (None, "m", at(5), None),
        (2, "c", at(1), None),
    ])


READING = "city string, at timestamp, temperature double, label string"


def some_readings(seed, n=600):
    rnd = random.Random(seed)
    start = dt.datetime(2024, 3, 1, tzinfo=dt.timezone.utc)
    rows = []
    for _ in range(n):
        moment = start + dt.timedelta(minutes=rnd.randrange(0, 7 * 1440)) if rnd.random() > 0.02 else None
        rows.append((rnd.choice(["a", "b", None]), moment, 1e6 + rnd.gauss(0, 1) if rnd.random() > 0.1 else None, rnd.choice("xyz")))
    return rows


def test_merged_states_equal_statistics_of_all_rows(spark, tmp_path):
    rows = some_readings(1)
    df = spark.createDataFrame(rows, READING)
    path = str(tmp_path / "states")
    daily.refresh(df, path, ["city"], "at", ["temperature", "label"])
    states = daily.read_states(spark, path)
    found = {r.city: r for r in daily.over_range(states, ["city", "field"], dt.date(2024, 3, 2), dt.date(2024, 3, 5)).filter("field = 'temperature'").collect()}
    for city in ("a", "b", None):
        inside = [r for r in rows if r[0] == city and r[1] and dt.date(2024, 3, 2) <= r[1].date() <= dt.date(2024, 3, 5)]
        values = sorted(r[2] for r in inside if r[2] is not None)
        mean = sum(values) / len(values)
        row = found[city]
        assert (row.total, row.non_null, row.null_count) == (len(inside), len(values), len(inside) - len(values))
        assert (row.min_value, row.max_value) == (values[0], values[-1])
        assert row.avg_value == pytest.approx(mean)
        assert row.std_dev == pytest.approx(math.sqrt(sum((v - mean) ** 2 for v in values) / (len(values) - 1)), rel=1e-4)
        for name, share in (("q05", 0.05), ("q50", 0.5), ("q95", 0.95)):
            rank = sum(v <= row[name] for v in values) / len(values)
            assert abs(rank - share) < 0.03 + 1 / len(values)
        assert abs(row.distinct_values - len(set(values))) <= 2 + 0.06 * len(values)
    text = daily.state_profile(states).filter("field = 'label'").first()
    assert text.distinct_values == 3
    assert (text.non_null, text.q50) == (0, None)


def test_refresh_writes_only_the_days_of_late_rows(spark, tmp_path):
    rows = some_readings(2)
    path = str(tmp_path / "states")
    late = [r for r in rows if r[1] and r[1].day in (3, 6) and r[3] == "x"]
    first = spark.createDataFrame([r for r in rows if r not in late], READING)
    daily.refresh(first, path, ["city"], "at", ["temperature"])
    before = files_of(path)
    every = spark.createDataFrame(rows, READING)
    days = daily.days_of(spark.createDataFrame(late, READING), "at")
    assert days == [dt.date(2024, 3, 3), dt.date(2024, 3, 6)]
    for _ in range(2):
        daily.refresh(every, path, ["city"], "at", ["temperature"], days)
    after = files_of(path)
    kept = {name for name in before if "date=2024-03-03" not in name and "date=2024-03-06" not in name}
    assert {name: after.get(name) for name in kept} == {name: before[name] for name in kept}
    exact = ["city", "date", "field", "rows", "n", "low", "high"]
    have = Counter(tuple(r) for r in daily.read_states(spark, path).select(exact).collect())
    want = Counter(tuple(r) for r in daily.daily_states(every, ["city"], "at", ["temperature"]).select(exact).collect())
    assert have == want
    daily.refresh(every, path, ["city"], "at", ["temperature"], [])
    assert files_of(path) == after


def test_ledger_neither_loses_nor_doubles(spark, tmp_path):
    root, path = tmp_path / "landing", str(tmp_path / "table")

    def land(name, *numbers):
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text("".join(f'{{"n": {n}}}\n' for n in numbers))

    def load(**more):
        return ledger.load_pending(spark, str(root), path, lambda files: spark.read.schema("n long").json(files), "*.json", **more)

    land("d1/a.json", 1, 2)
    land("d1/b c.json", 3)
    land("d1/skip.txt", 99)
    assert load() == [1]
    assert load() == []
    land("d2/a.json", 4)

    def lost(files):
        spark.read.schema("n long").json(files).write.parquet(f"{path}/rows/load=2")
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError):
        ledger.load_pending(spark, str(root), path, lost, "*.json")
    assert sorted(r.n for r in ledger.read_loaded(spark, path).collect()) == [1, 2, 3]
    land("d2/b.json", 5)
    land("d2/c.json", 6)
    assert load(most_files=2) == [2, 3]
    assert sorted(r.n for r in ledger.read_loaded(spark, path).collect()) == [1, 2, 3, 4, 5, 6]
    assert ledger.changed(spark, str(root), path).isEmpty()
    os.remove(root / "d1/a.json")
    land("d2/a.json", 4, 7)
    assert {(Path(r.path).parent.name, r.now is None) for r in ledger.changed(spark, str(root), path).collect()} == {("d1", True), ("d2", False)}


def test_interleaving_prunes_by_the_second_column(spark, tmp_path):
    rnd = random.Random(3)
    rows = [(rnd.randrange(100_000), f"k{rnd.randrange(10**6):06}" if k % 50 else None, k) for k in range(20_000)]
    df = spark.createDataFrame(rows, "a long, b string, c long")

    def groups_met(path, column, low, high):
        met = total = 0
        for name in Path(path).glob("*.parquet"):
            meta = pq.ParquetFile(name).metadata
            at = next(k for k in range(meta.num_columns) if meta.schema.column(k).name == column)
            for g in range(meta.num_row_groups):
                stats = meta.row_group(g).column(at).statistics
                total += 1
                met += not (stats.has_min_max and (stats.max < low or stats.min > high))
        return met, total

    plain, woven = str(tmp_path / "plain"), str(tmp_path / "woven")
    df.repartitionByRange(64, "a", "b").sortWithinPartitions("a", "b").write.parquet(plain)
    writers.interleaved_layout(df, ["a", "b"], 64).write.parquet(woven)
    met, total = groups_met(plain, "b", "k500000", "k510000")
    assert met == total
    met, total = groups_met(woven, "b", "k500000", "k510000")
    assert met <= 0.35 * total
    met, total = groups_met(woven, "a", 50_000, 51_000)
    assert met <= 0.35 * total
    assert Counter(tuple(r) for r in spark.read.parquet(woven).collect()) == Counter(rows)
    assert writers.interleaved_layout(df.limit(0), ["a", "b"], 4).count() == 0


def test_schemas_are_resolved(spark):
    f = resolution.field
    writer = t.StructType([
        t.StructField("id", t.IntegerType(), False), t.StructField("old", t.FloatType()), t.StructField("raw", t.BinaryType()),
        t.StructField("gone", t.StringType()),
        t.StructField("list", t.ArrayType(t.StructType([t.StructField("x", t.IntegerType())]))),
        t.StructField("map", t.MapType(t.StringType(), t.IntegerType())),
    ])
    rows = spark.createDataFrame([(1, 0.5, bytearray(b"hi"), "g", [(1,), None], {"k": 3}), (2, None, None, None, None, None)], writer)
    reader = t.StructType([
        f("id", t.LongType()), f("new", t.DoubleType(), aliases=("older", "old")), f("raw", t.StringType()),
        f("list", t.ArrayType(t.StructType([f("x", t.DoubleType()), f("y", t.StringType(), default="d")]))),
        f("map", t.MapType(t.StringType(), t.LongType())), f("nothing", t.LongType(), default=None),
        f("tags", t.ArrayType(t.StringType()), default=["a"]),
    ])
    found = resolution.resolve(rows, reader)
    assert [(x.name, x.dataType.simpleString()) for x in found.schema] == [(x.name, x.dataType.simpleString()) for x in reader]
    one, two = sorted(found.collect(), key=lambda r: r.id)
    assert one.asDict(True) == {"id": 1, "new": 0.5, "raw": "hi", "list": [{"x": 1.0, "y": "d"}, None], "map": {"k": 3}, "nothing": None, "tags": ["a"]}
    assert (two.new, two.raw, two.list, two.map) == (None, None, None, None)


@pytest.mark.parametrize(("old", "new", "answer"), [
    ("a int", "a long", "backward"),
    ("a long", "a int", "forward"),
    ("a int", "a int", "full"),
    ("a string", "a binary", "full"),
    ("a string", "a int", "none"),
    ("a int", "a int, b int", "forward"),
    ("a int, b int", "a int", "backward"),
    ("a array<int>", "a array<double>", "backward"),
    ("a struct<x: int>", "a struct<x: int, y: int>", "forward"),
    ("a map<string, long>", "a map<string, int>", "forward"),
])
def test_which_schema_reads_the_other(old, new, answer):
    old, new = t.StructType.fromDDL(old), t.StructType.fromDDL(new)
    assert resolution.compatibility(old, new) == answer


def test_a_reader_that_cannot_read_is_refused(spark):
    reader = t.StructType([resolution.field("id", t.StringType()), resolution.field("x", t.LongType(), False), resolution.field("y", t.LongType())])
    rows = spark.createDataFrame([(1, 2)], "id long, x long")
    with pytest.raises(ValueError, match="id: bigint can't be read as string; x: may be NULL.*; y: not stored"):
        resolution.resolve(rows, reader)


def test_json_is_parsed_once_a_row(spark):
    rows = [(1, '{"a": {"b": 5, "c": "x"}, "l": [1, 2]}'), (2, "no json"), (3, None), (4, '{"a": 3}')]
    paths = {"b": ("$.a.b", "long"), "c": ("$.a.c", "string"), "l": ("$.l[1]", "double"), "b_text": ("$.a.b", "string")}
    found = variants.read_paths(spark.createDataFrame(rows, "id long, raw string"), "raw", paths, ["id"])
    assert [tuple(r) for r in found.orderBy("id").collect()] == [
        (1, 5, "x", 2.0, "5"), (2, None, None, None, None), (3, None, None, None, None), (4, None, None, None, None)
    ]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("VariantExpressionEvalUtils") == 1


def test_rank_by_period_equals_a_window(spark):
    rnd = random.Random(5)
    start = dt.datetime(2024, 1, 1, tzinfo=dt.timezone.utc)
    rows = [(rnd.choice(["a", "b", None]), start + dt.timedelta(seconds=rnd.randrange(600)), k) for k in range(400)]
    rows += [("a", None, 900)]
    df = spark.createDataFrame(rows, "city string, at timestamp, id long")
    found = {r.id: r.row_num for r in ranking.rank_by_period(df, "city", "at").collect()}
    for city in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == city), key=lambda r: (-(r[1].timestamp() if r[1] else 0), r[2]))
        assert [found[r[2]] for r in mine] == list(range(1, len(mine) + 1))


def test_views_are_given_back(spark):
    spark.range(3).createOrReplaceTempView("weather_batch_mine")
    with readers.named_views(spark, {"weather_batch_mine": spark.range(5)}, ["made_inside"]):
        inside = spark.table("weather_batch_mine")
        spark.range(1).createOrReplaceTempView("made_inside")
    assert inside.count() == 5
    assert spark.table("weather_batch_mine").count() == 3
    assert not spark.catalog.tableExists("made_inside")
    spark.catalog.dropTempView("weather_batch_mine")
