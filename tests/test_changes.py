from datetime import date, datetime

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tablestream.operators import changes

TARGET = "id long, name string, email string"
CHANGE = f"{TARGET}, seq long, op string"


def replay(target, log):
    state, rejected = {k: [n, e] for k, n, e in target}, []
    for key, name, email, seq, op in sorted(log, key=lambda c: c[3]):
        if (op == "I") == (key in state):
            rejected.append(seq)
        elif op == "I":
            state[key] = [name, email]
        elif op == "D":
            del state[key]
        else:
            old = state[key]
            state[key] = [name if name is not None else old[0],
                          email if email is not None else old[1]]
    return sorted((k, *v) for k, v in state.items()), sorted(rejected)


def applied(spark, target, log, block_rows=100_000):
    state, rejected = changes.apply_changes(
        spark.createDataFrame(target, TARGET), spark.createDataFrame(log, CHANGE),
        "id", "seq", block_rows,
    )
    return (
        sorted(tuple(r) for r in state.collect()),
        sorted(r.seq for r in rejected.select("seq").collect()),
    )


def test_edge_cases(spark):
    target = [(1, "a", "a@x"), (2, "b", "b@x"), (3, "c", None)]
    log = [
        (1, "A", None, 1, "U"),
        (1, None, "new@x", 2, "U"),
        (2, None, None, 3, "D"),
        (2, "b2", None, 4, "I"),
        (9, "nobody", None, 5, "U"),
        (8, None, None, 6, "D"),
        (3, "again", None, 7, "I"),
        (7, "g", "g@x", 8, "I"),
    ]
    state, rejected = applied(spark, target, log)
    assert (state, rejected) == replay(target, log)
    assert state == [(1, "A", "new@x"), (2, "b2", None), (3, "c", None), (7, "g", "g@x")]
    assert rejected == [5, 6, 7]
    sparse = [(k, n, e, seq * 10**12, op) for k, n, e, seq, op in log]
    for rows in (1, 3, 100):
        assert applied(spark, target, sparse, rows) == replay(target, sparse)
    assert applied(spark, target, []) == replay(target, [])


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(
        st.tuples(
            st.integers(1, 4), st.sampled_from([None, "n", "m"]), st.sampled_from([None, "e"]),
            st.sampled_from("IUUD"),
        ),
        min_size=1, max_size=40,
    ),
    st.integers(1, 10),
)
def test_replay_of_any_log(spark, log, block_rows):
    target = [(1, "a", "x"), (2, "b", None)]
    rows = [(k, n, e, seq, op) for seq, (k, n, e, op) in enumerate(log)]
    assert applied(spark, target, rows, block_rows) == replay(target, rows)


def test_ten_users(spark):
    """Insert ten, update the first, delete the second: nine are left."""
    log = [(i, f"u{i}", f"u{i}@x", i, "I") for i in range(1, 11)]
    log += [(1, "first", None, 11, "U"), (2, None, None, 12, "D")]
    state, rejected = applied(spark, [], log)
    assert len(state) == 9 and state[0] == (1, "first", "u1@x") and rejected == []


def test_unique_on_load(spark):
    old = spark.createDataFrame([(1, "a@x")], "seq long, email string")
    new = spark.createDataFrame(
        [(2, "a@x"), (3, "b@x"), (4, "b@x"), (5, None), (6, None)], "seq long, email string"
    )
    accepted, rejected = changes.unique_on_load(old, new, ["email"], "seq")
    assert sorted(r.seq for r in accepted.collect()) == [3, 5, 6]
    assert sorted(r.seq for r in rejected.collect()) == [2, 4]


SNAP = "id long, v string, updated_at date"


def test_snapshot_versions(spark):
    def day(n):
        return date(2024, 1, n)

    first = [(i, "old", day(5)) for i in (1, 2, 3, 4)]
    second = [(1, "new", day(6)), (2, "same", day(5)), (3, "older", day(4)), (5, "added", day(9))]
    history = changes.snapshot(None, spark.createDataFrame(first, SNAP), "id", "updated_at")
    history = changes.snapshot(history, spark.createDataFrame(second, SNAP), "id", "updated_at")
    rows = sorted((r.id, r.v, r.valid_from, r.valid_to) for r in history.collect())
    assert rows == [
        (1, "new", day(6), None), (1, "old", day(5), day(6)), (2, "old", day(5), None),
        (3, "old", day(5), None), (4, "old", day(5), None), (5, "added", day(9), None),
    ]


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.dictionaries(st.integers(1, 3), st.integers(1, 20)), min_size=1, max_size=4))
def test_versions_of_a_key_never_overlap(spark, states):
    history = None
    for state in states:
        rows = [(k, "v", date(2024, 1, d)) for k, d in state.items()]
        history = changes.snapshot(
            history, spark.createDataFrame(rows, SNAP), "id", "updated_at"
        )
    versions = {}
    for row in history.collect():
        versions.setdefault(row.id, []).append((row.valid_from, row.valid_to))
    for spans in versions.values():
        spans.sort(key=lambda s: s[0])
        assert spans[-1][1] is None
        for (_, end), (start, _) in zip(spans, spans[1:], strict=False):
            assert end == start


def test_add_rows(spark):
    one = spark.createDataFrame([(1, datetime(2024, 1, 1))], "id long, t timestamp")
    assert changes.add_rows(one, one).count() == 2


def test_null_keys_are_keys(spark):
    target = spark.createDataFrame([(None, 5), (1, 6)], "id long, v long")
    log = spark.createDataFrame(
        [(1, "U", None, 7), (2, "U", 3, 8), (3, "D", 1, None), (4, "I", None, 9)],
        "seq long, op string, id long, v long",
    )
    state, rejected = changes.apply_changes(target, log, "id", "seq")
    assert [tuple(r) for r in state.collect()] == [(None, 7)]
    assert sorted((r.seq, r.reason) for r in rejected.collect()) == [(2, "missing"), (4, "exists")]


def test_one_far_number_does_not_put_the_log_into_one_block(spark):
    rows = [(k, "U", k % 5, k) for k in range(1000)] + [(10**15, "D", 1, None)]
    log = spark.createDataFrame(rows, "seq long, op string, id long, v long")
    blocks = changes._blocked(log, "seq", 100).groupBy("_block").count().collect()
    assert len(blocks) >= 8 and max(r["count"] for r in blocks) <= 300
    target = spark.createDataFrame([(k, 0) for k in range(5)], "id long, v long")
    state, _ = changes.apply_changes(target, log, "id", "seq", block_rows=100)
    assert sorted(tuple(r) for r in state.collect()) == [(0, 995), (2, 997), (3, 998), (4, 999)]
