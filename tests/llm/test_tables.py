"""Operators on tables: shuffles, mixtures, nearest vectors, toxicity; the registered SQL."""

import itertools
import math
import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tablestream.llm import mixing, sharding, topk, toxicity
from tablestream.llm import queries  # noqa: F401
from tablestream.llm.registry import ORACLES, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("rows", [1, 2, 3, 5, 64, 65, 82, 1000])
def test_positions_are_a_permutation(spark, rows):
    found = spark.range(rows).select(sharding.permuted(F.col("id"), rows, 3).alias("p"))
    assert sorted(r.p for r in found.collect()) == list(range(rows))


def test_shards_are_even_and_gapless(edge_docs, no_docs):
    order = [F.col("doc_id"), F.col("text"), F.col("source")]
    placed = sharding.shard_rows(edge_docs.withColumn("slot", F.lit("old")), order, 4).collect()
    again = sharding.shard_rows(edge_docs.repartition(7), order, 4).collect()
    assert Counter((r.doc_id, r.text, r.shard, r.slot) for r in placed) == Counter(
        (r.doc_id, r.text, r.shard, r.slot) for r in again
    )
    by_shard = {s: sorted(r.slot for r in placed if r.shard == s) for s in range(4)}
    assert all(slots == list(range(len(slots))) for slots in by_shard.values())
    assert max(map(len, by_shard.values())) - min(map(len, by_shard.values())) <= 1
    assert sharding.shard_rows(no_docs, order, 4).count() == 0


def targets_by_hand(sizes, weights=(5, 2, 1), limit=3):
    names = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: weights[k % len(weights)] for k, s in enumerate(names)}
    target, open_, left = {}, set(names), sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > limit * sizes[s]}
        if not over:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: limit * sizes[s] for s in over}
        left -= sum(target[s] for s in over)
        open_ -= over
    return target


def test_mixture_meets_targets(spark):
    rnd = random.Random(2)
    rows = [(k, rnd.choice(["a", "b", "c", "Z", None]), rnd.randrange(0, 300)) for k in range(3000)]
    rows += [(5000, "tiny", 4), (5001, "none", 0), (None, "a", 50), (7, rows[7][1], rows[7][2])]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long").withColumn("mean", F.lit("old"))
    found = mixing.mix(docs, F.col("size")).collect()
    sizes = Counter()
    for _, source, size in rows:
        sizes[source] += size
    want = targets_by_hand(sizes)
    taken = Counter()
    for r in found:
        assert r.target == pytest.approx(want[r.source], rel=1e-9, abs=1e-6)
        assert (r.source_size, r.mean) == (sizes[r.source], "old")
        assert 0 <= r.copies <= 3
        taken[r.source] += r.copies * r.size
    for source, target in want.items():
        assert abs(taken[source] - target) <= max(300, 0.01 * target)
    assert len(found) == len(rows)
    again = mixing.mix(docs.repartition(5), F.col("size")).collect()
    assert Counter((r.doc_id, r.copies) for r in again) == Counter((r.doc_id, r.copies) for r in found)


def test_mixture_of_nothing(no_docs):
    assert mixing.mix(no_docs, F.lit(1)).count() == 0


def test_nearest_vectors_match_brute_force(spark):
    rnd = random.Random(4)
    base = [[rnd.uniform(-1, 1) for _ in range(6)] for _ in range(40)]
    rows = [(k, [float(x) for x in rnd.choice(base)]) for k in range(300)]
    rows += [(300, None), (301, [1.0, None]), (302, [float("nan")] * 6), (303, [1.0, math.inf]), (None, base[0])]
    rows += [(304, []), (305, [0.5, 0.25]), (306, base[1]), (306, base[1])]
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    found = topk.nearest(vectors, 7, F.col("vec_id") % 50 == 0).collect()
    good = {
        k: [math.floor(1024 * x) for x in v] for k, v in rows
        if k is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    }
    want = set()
    for q in (k for k in good if k % 50 == 0):
        scored = sorted((-sum(x * y for x, y in zip(good[q], v, strict=False)), k) for k, v in good.items() if k != q)
        want |= {(q, n, k, -s) for n, (s, k) in enumerate(scored[:7], 1)}
    assert {tuple(r) for r in found} == want and len(found) == len(want)
    assert topk.nearest(vectors.limit(0), 7, F.lit(True)).count() == 0
    assert topk.nearest(vectors.filter("vec_id = 3"), 7, F.lit(True)).count() == 0


def test_toxic_words_are_found(spark):
    rnd = random.Random(6)
    plain = [f"word{k}" for k in range(300)]
    rows, labels = [], []
    for k in range(400):
        words = [rnd.choice(plain) for _ in range(40)]
        if toxic := k % 5 == 0:
            for at in rnd.sample(range(40), 3):
                words[at] = rnd.choice(["Vileword", "nastyterm"]) + rnd.choice(["", "s", "er"])
        rows.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    rows += [(1000, None), (1001, ""), (None, "Vileword nastyterm nastyterms")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    known = spark.createDataFrame([*labels[:300], (None, 1), (2, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, known)
    found = {r.doc_id: r for r in toxicity.score(docs.withColumn("toxic_score", F.lit(9)), model).collect()}
    wrong = [k for k, y in labels[300:] if (found[k].toxic_score >= 0.5) != bool(y)]
    assert len(wrong) <= 2
    spans = [found[0].text[s.start : s.end] for s in found[0].toxic_spans]
    assert spans and all(word.startswith(("Vile", "nasty")) for s in spans for word in s.split())
    assert found[1000].toxic_spans == found[1001].toxic_spans == []
    assert found[1000].toxic_score == found[1001].toxic_score < 0.5 < found[None].toxic_score
    assert {r.toxic_score for r in toxicity.score(docs, toxicity.fit(docs, known.limit(0))).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), model).count() == 0


def sql_rows(sql):
    db = duckdb.connect()
    for name in ("documents", "embeddings", "labels"):
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{DATA}/{name}.parquet'")
    cursor = db.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(names)
    return Counter(tuple(dict(zip(names, row, strict=True))[n] for n in order) for row in cursor.fetchall())


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_matches_sql(spark, name):
    df = QUERIES[name](spark, DATA)
    order = sorted(df.columns)
    assert Counter(tuple(r[n] for n in order) for r in df.collect()) == sql_rows(ORACLES[name])


@pytest.mark.parametrize("name", [n for n in QUERIES if n not in ORACLES])
def test_other_queries_have_a_row_for_each_document(spark, name):
    documents = spark.read.parquet(f"{DATA}/documents.parquet")
    found = QUERIES[name](spark, DATA)
    assert found.select("doc_id").exceptAll(documents.select("doc_id")).isEmpty()
    assert found.count() == documents.count()


@pytest.mark.parametrize("name", ["op2_sharding", "op4_quality_rules", "op9_mixing"])
def test_python_runs_only_where_it_may(spark, name):
    plan = QUERIES[name](spark, DATA)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_targets_are_those_of_the_dual(spark):
    """The rates of a source are its tilted documents: capped powers whose sizes add up to the target."""
    rnd = random.Random(4)
    rows = [(k, "ab"[k % 3 == 0], rnd.randrange(1, 90)) for k in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, size long")
    found = mixing.mix(docs, F.col("size")).collect()
    for source in "ab":
        mine = [r for r in found if r.source == source]
        sizes, rates = np.array([r.size for r in mine]), np.array([r.rate for r in mine])
        assert (rates * sizes).sum() == pytest.approx(mine[0].target, rel=1e-6)
        free = rates < mixing.LIMIT - 1e-9
        slope = np.log(rates[free]) / sizes[free]
        assert slope == pytest.approx(np.full(len(slope), slope[0]), rel=1e-6)


def test_stages_take_columns_with_clashing_names(spark):
    names = ["_row", "_copy", "_key", "copies", "toxic_score", "n_removed", "group", "id", "rep", "bucket", "key"]
    base = " ".join(f"w{k}" for k in range(40))
    rows = [(k, base if k < 3 else f"{base[k:]} {k} x" * 3, f"s{k % 2}") for k in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    clash = docs.select("*", *(F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain, odd = stage(spark, docs, DATA), stage(spark, clash, DATA)
        assert odd.columns == clash.columns
        kept = odd.collect()
        assert Counter((r.doc_id, r.text) for r in kept) == Counter(tuple(r)[:2] for r in plain.collect()), name
        assert all(r[n] == f"{n}-{r.doc_id}" for r in kept for n in names)


def test_pipeline_stages(spark):
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "toxicity", "near_duplicates", "repeated_passages", "mixture", "byte_bpe",
    ]
    out = corpus_pipeline.run(spark, DATA)
    assert out.filter("NOT decodes OR n_tokens != size(ids)").isEmpty()
    assert 0 < out.select("doc_id").distinct().count() < spark.read.parquet(f"{DATA}/documents.parquet").count()


def test_pipeline_takes_odd_rows(spark, edge_docs, tmp_path):
    docs = edge_docs.withColumn("n_chars", F.length("text"))
    docs.write.parquet(f"{tmp_path}/docs")
    docs = spark.read.parquet(f"{tmp_path}/docs")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, DATA)
        out.write.parquet(f"{tmp_path}/{name}")
        docs = spark.read.parquet(f"{tmp_path}/{name}")
    assert docs.filter("NOT decodes").isEmpty()


def test_pipeline_keeps_other_texts_of_an_id(spark):
    base, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(0, base, "s"), (1, base, "s"), (1, other, "s"), (1, other, "s"), (5, other + " x", "s"), (5, other + " y", "s"), (6, None, "s")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = corpus_pipeline.drop_near_duplicates(spark, docs, "")
    assert sorted((r.doc_id, r.text) for r in kept.filter("text IS NOT NULL").collect()) == [(0, base), (1, other)]
    assert kept.filter("text IS NULL").count() == 1


def test_mixture_survives_another_split_of_the_files(spark, tmp_path):
    rows = [(k, "w " * (k % 50), f"s{k % 3}") for k in range(3000)]
    path = str(tmp_path / "docs")
    spark.createDataFrame(rows, "doc_id long, text string, source string").coalesce(2).write.parquet(path)
    found = []
    for size in ("4k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            mixed = corpus_pipeline.mix_sources(spark, spark.read.parquet(path), "")
            spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
            found.append(Counter((r.doc_id, r.text) for r in mixed.collect()))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert found[0] == found[1]
    assert all(text == "w " * (k % 50) for k, text in found[0])


def test_chain_sums_match_enumeration():
    rnd = np.random.default_rng(6)
    potential, chain = rnd.normal(size=7), rnd.normal(size=(2, 2))
    first = np.array([True, False, False, True, True, False, False])
    forward, backward, matrices = toxicity.forward_backward(potential, chain, first)
    both = forward * backward
    have = both[1] / both.sum(axis=0)
    inner = np.flatnonzero(~first)
    joint = forward[:, None, inner - 1] * matrices[..., inner] * backward[None, :, inner]
    joint /= joint.sum(axis=(0, 1))
    want, pairs, total = np.zeros(7), np.zeros((2, 2, 7)), 0.0
    for path in itertools.product((0, 1), repeat=7):
        value = sum(potential[k] * y for k, y in enumerate(path))
        value += sum(chain[path[k - 1], path[k]] for k in range(1, 7) if not first[k])
        weight = math.exp(value)
        total += weight
        want += weight * np.array(path)
        for k in inner:
            pairs[path[k - 1], path[k], k] += weight
    assert have == pytest.approx(want / total)
    assert joint == pytest.approx(pairs[..., inner] / total)


def test_toxic_words_of_a_small_language(spark):
    """One language has a fiftieth of the labels, and each of its words for offence few of those."""
    rnd = random.Random(9)
    vocabulary = {"a": [f"al{k}" for k in range(300)], "b": [f"bo{k}" for k in range(300)]}
    slurs = {"a": ["zonk", "grub", "vexx"], "b": ["quorr", "plift", "dremm"]}
    rows, labels = [], []
    for k in range(3000):
        lang, bad = ("b" if k % 20 == 0 else "a"), rnd.random() < 0.15
        words = [rnd.choice(vocabulary[lang]) for _ in range(40)]
        if bad:
            for _ in range(2):
                words[rnd.randrange(40)] = rnd.choice(slurs[lang])
        rows.append((k, " ".join(words), lang))
        labels.append((k, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.fit(docs, labels.filter("doc_id % 5 != 0 OR doc_id % 20 = 0"), per_class=150)
    found = toxicity.score(docs, model).join(labels, "doc_id").select("lang", "toxic", "toxic_score").collect()
    for lang in "ab":
        right = [(r.toxic_score >= 0.5) == (r.toxic == 1) for r in found if r.lang == lang]
        assert sum(right) >= 0.97 * len(right)


def test_ids_with_two_vectors_ask_by_the_least(spark):
    rows = [(0, [1.0, 0.0]), (0, [0.5, 2.0]), (1, [1.0, 1.0]), (1, [3.0, 0.0]), (2, [0.0, 5.0])]
    vectors = spark.createDataFrame(rows * 2, "vec_id long, embedding array<double>").repartition(4)
    found = topk.nearest(vectors, 3, F.col("vec_id") % 100 == 0).collect()
    one = 1024 * 1024
    assert {(r.query_id, r.rank, r.vec_id, r.score) for r in found} == {
        (0, 1, 2, 10 * one), (0, 2, 1, int(2.5 * one)), (0, 3, 1, int(1.5 * one))
    }
