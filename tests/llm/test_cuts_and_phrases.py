"""Fill-in-middle and phrase collocations against brute force, over edge cases."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tablestream.llm import fim, phrases

LOWER = {c: c + 32 for c in range(65, 91)}


@pytest.mark.parametrize("step", [1, 2, 9, 400])
def test_rank_index_is_exact_and_bounded(step):
    rnd = np.random.default_rng(step)
    for n in (1, 2, 3, 500, 20_000):
        offsets = np.cumsum(rnd.integers(1, step + 1, n)) - 1
        index = fim.RankIndex.fit(offsets)
        ranks = np.arange(n)
        assert (index(ranks) == offsets).all()
        assert np.abs(index.predicted(ranks) - offsets).max() <= fim.BOUND
        assert len(index.first) <= max(1, n // 2) or step == 400


def cut_by_hand(doc_id, text):
    text = text or ""
    tokens = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(tokens)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not text or any(mark in text for mark in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    prefix, middle, suffix = ("".join(x) for x in (tokens[:a], tokens[a:b], tokens[b:]))
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_cuts_match_brute_force(spark, edge_rows):
    texts = ["<P>", "a <S> b", "<M", "<<P", "<S", "S> x", "é", "\n", "a" * 5000, "日本語 and 日本", "a\x00b"]
    rows = [*((r[0], r[1]) for r in edge_rows), *((1000 + k, texts[k % len(texts)]) for k in range(60))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("form", F.lit("old"))
    docs = docs.withColumn("_draw1", F.lit(7)).repartition(3)
    cut = fim.transform(docs).withColumn("again", fim.restored(F.col("output"), F.col("form")))
    found = cut.collect()
    assert cut.columns[:3] == ["doc_id", "text", "_draw1"]
    have = Counter((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in found)
    assert have == Counter((d, t, *cut_by_hand(d, t)) for d, t in rows)
    assert {r.form for r in found} == {"plain", "psm", "spm"}
    assert all(r.again == (r.text or "") for r in found)


def test_cuts_of_nothing(no_docs):
    assert fim.transform(no_docs).count() == 0


def collocations_by_hand(rows, least):
    counts, totals = defaultdict(Counter), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for k in range(1, 6):
                for i in range(len(words) - k + 1):
                    counts[lang][tuple(words[i : i + k])] += 1
    out = {}
    for lang, count in counts.items():
        kept = {g: f for g, f in count.items() if f >= least}
        for g, a in kept.items():
            inside = any(
                len(q) > len(g) and f >= a and any(q[i : i + len(g)] == g for i in range(len(q)))
                for q, f in kept.items()
            )
            if len(g) > 1 and not inside:
                score, k = min((1000 * a * totals[lang] // (kept[g[:k]] * kept[g[k:]]), k) for k in range(1, len(g)))
                out[lang, " ".join(g)] = (a, kept[g[:k]], kept[g[k:]], totals[lang], score)
    return out


@pytest.mark.parametrize(("least", "many"), [(2, False), (2, True), (4, True)])
def test_collocations_match_brute_force(spark, edge_rows, least, many, monkeypatch):
    if many:  # blocks and ranges
        for name, value in (("BLOCK_BYTES", 3000), ("RANGE_ROWS", 60), ("SAMPLE_EVERY", 6)):
            monkeypatch.setattr(phrases, name, value)
    rnd = random.Random(least)
    rows = [(r[1], r[2]) for r in edge_rows]
    some = ["of", "the", "The", "été", "🙂", "x", "a\x01b", "a", "y'all", "b"]
    for _ in range(80):
        text = "".join(rnd.choice(some) + rnd.choice([" ", " ", " ", "\t", ", ", ".", "  ", "\n"]) for _ in range(60))
        rows.append((text, rnd.choice(["en", "fr", None, "und"])))
    # A hot line in a third of the rows, and a word that repeats itself.
    rows += [("new york city hall is the place to be", "en")] * 60 + [("no no no no no no no", "fr")] * 3
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("key", F.lit(1)).repartition(5)
    found = phrases.collocations(docs, least=least).collect()
    have = {(r.lang, r.phrase): (r.a, r.l, r.r, r.n, r.score) for r in found}
    assert len(have) == len(found)
    assert have == collocations_by_hand(rows, least)


def test_first_phrases_of_each_language(spark):
    rows = [("a", f"p{k}", 10, k // 2) for k in range(9)] + [("b", "q", 1, 1)]
    found = phrases.top(spark.createDataFrame(rows, "lang string, phrase string, a long, score long"), 3).collect()
    assert {(r.lang, r.rank, r.phrase) for r in found} == {("a", 1, "p8"), ("a", 2, "p6"), ("a", 3, "p7"), ("b", 1, "q")}


def test_collocations_of_nothing(no_docs, edge_docs):
    assert phrases.collocations(no_docs).count() == 0
    assert phrases.collocations(edge_docs.filter("text IS NULL OR trim(text) = ''")).count() == 0
    assert phrases.collocations(edge_docs, least=10**6).count() == 0
