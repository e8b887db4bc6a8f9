"""Operators on whole texts against brute force, over edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from tablestream.llm import bpe, langmodel, licenses, minhash, repeats, rules
from tablestream.llm.idfilter import IdFilter
from tablestream.llm.runindex import RunIndex

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text):
    w = WORD.findall((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def test_near_duplicates_match_all_pairs(edge_docs, edge_rows):
    rows = [(d, shingles(t)) for d, t, *_ in edge_rows if d is not None]
    component = {d: d for d, _ in rows}

    def root(d):
        while component[d] != d:
            d = component[d]
        return d

    for d, x in rows:
        for e, y in rows:
            if x and y and 100 * len(x & y) >= 75 * len(x | y):
                a, b = sorted((root(d), root(e)))
                component[b] = a
    want = Counter((d, len(s), root(d), root(d) == d) for d, s in rows)
    found = minhash.near_duplicates(edge_docs).collect()
    assert Counter(tuple(r) for r in found if r.doc_id is not None) == want
    assert [r.kept for r in found if r.doc_id is None] == [True, True]


def cut_by_hand(rows, length=100):
    rows = sorted(rows, key=lambda r: r[0])
    seen, out = set(), {}
    for d, t, *_ in rows:
        raw = (t or "").encode()
        gone = bytearray(len(raw))
        for i in range(len(raw) - length + 1):
            s = raw[i : i + length]
            if s in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(s)
        kept = bytes(b for b, g in zip(raw, gone, strict=True) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        out[d] = (len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("hot", [repeats.HOT, 1])
def test_repeats_match_brute_force(spark, edge_rows, hot):
    rows = list({r[0]: r for r in edge_rows if r[0] is not None}.values())
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, rest string").repartition(3)
    found = repeats.without_repeats(docs, hot=hot).collect()
    want = cut_by_hand(rows)
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == want
    texts = {d: (t, lang, rest) for d, t, lang, rest in rows}
    for r in found:
        assert (r.lang, r.rest) == texts[r.doc_id][1:]
        if not r.n_removed:
            assert r.text == (texts[r.doc_id][0] or "")


def test_run_index_names_the_earliest_place():
    texts = [b"abracadabra", b"cadabra", b"abracadabr", b"", b"zzzzzz"]
    index = RunIndex(texts, 4)
    place, least = index.earliest()
    flat = b"\0".join(texts) + b"\0"
    for p, q in zip(place.tolist(), least.tolist(), strict=True):
        assert q == flat.find(flat[p : p + 4])
    assert index.runs < len(flat)


def test_scores_match_word_counts(edge_docs, edge_rows):
    words = [(d, [*WORD.findall((t or "").translate(LOWER)), None]) for d, t, *_ in edge_rows]

    def aside(d):
        return zlib.crc32(b"" if d is None else str(d).encode()) % 7 == 2

    counts = Counter(w for d, ws in words if not aside(d) for w in ws)
    n, v = sum(counts.values()), len(counts)
    want = Counter(
        (d, aside(d), len(ws), sum(counts[w] > 0 for w in ws), n,
         round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws), 6))
        for d, ws in words
    )
    found = langmodel.score_texts(edge_docs, 7, 2).collect()
    assert want == Counter(
        (r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in found
    )
    assert all(r.score < 0 for r in found)


def test_context_tells_words_of_one_class_apart(spark):
    # Words of one key, and so of one class, equally often; each context has its own.
    words = [f"ab{k}xcd" for k in range(8)]
    pairs = [(f"left{k}", w) for k, w in enumerate(words)]
    rnd = random.Random(3)
    texts = [" ".join(x for _ in range(20) for x in rnd.choice(pairs)) for _ in range(600)]
    swapped = [(a, words[(k + 1) % len(words)]) for k, (a, _) in enumerate(pairs)]
    texts += [" ".join(x for p in some for x in p * 5) for some in (pairs, swapped)]
    ids = [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 != 2][:600]
    ids += [k for k in range(3000) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    docs = spark.createDataFrame(list(zip(ids, texts, strict=True)), "doc_id long, text string")
    score = {r.doc_id: r.score for r in langmodel.score_texts(docs, 7, 2).collect()}
    assert score[ids[-2]] > score[ids[-1]] + 10


def test_tree_chances_sum_to_one():
    sizes = langmodel.Sizes(16, 3, 64)
    rnd = np.random.default_rng(1)
    trees = langmodel.Trees(sizes, rnd.integers(1, 9, (langmodel.CLASSES, 8)))
    leaf, own = np.arange(8), np.full(8, 5)
    codes = [np.full(8, c, np.uint32) for c in (11, 12, 13)]
    weights = rnd.normal(size=64).astype(np.float32)
    assert abs(np.exp(trees.log_chance(weights, own, leaf, codes)).sum() - 1) < 1e-5


def test_statistics_match_brute_force(edge_docs, edge_rows):
    def by_hand(t):
        t = t or ""
        w = WORD.findall(t)
        runs = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        often = Counter(runs)
        covered = {k for i, r in enumerate(runs) if often[r] > 1 for k in range(i, i + 5)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        return (len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered))

    found = rules.statistics(edge_docs).collect()
    assert Counter(
        (r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in found
    ) == Counter((d, *by_hand(t)) for d, t, *_ in edge_rows)


def test_rules_are_learned_from_labels(spark):
    texts = [("good text number " + " ".join(f"w{k}x{i}" for i in range(40)), 1) for k in range(120)]
    texts += [("### $$$ " * 20 + f"junk {k}", 0) for k in range(60)]
    docs = spark.createDataFrame([(k, t) for k, (t, _) in enumerate(texts)], "doc_id long, text string")
    labels = spark.createDataFrame(
        [(k, y) for k, (_, y) in enumerate(texts)] + [(None, 0), (3, None)], "doc_id long, quality int"
    )
    stats = rules.statistics(docs)
    learned = rules.learn(stats, labels)
    kept = stats.select("doc_id", (rules.verdict(learned) == 0).alias("kept")).collect()
    assert {r.doc_id: r.kept for r in kept} == {k: bool(y) for k, (_, y) in enumerate(texts)}
    assert rules.learn(stats, labels.filter("quality = 1")) == []
    assert rules.learn(stats, labels.limit(0)) == []


def test_licences(edge_docs, edge_rows):
    found = {(r.doc_id, r.text): r for r in licenses.scan(edge_docs.withColumn("score", F.lit("old"))).collect()}
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    for d, t, *_ in edge_rows:
        w = pattern.findall((t or "").translate(LOWER))
        r = found[(d, t)]
        hits = [i for i in range(len(w)) if w[i : i + 2] == ["mit", "license"]]
        assert (r.n_words, r.n_base) == (len(w), len(hits))
        assert r.base_labels == ("mit" if hits else "")
        assert ("cc-by-nc" in r.labels.split(",")) == bool(t and t.startswith("Licensed under CC"))
        assert 0 <= r.score <= 1


def scanned(spark, texts):
    rows = licenses.scan(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    return [r for _, r in sorted((r.doc_id, r) for r in rows)]


def test_edited_licences(spark):
    words = dict(licenses.TEMPLATES)["mit"].split()
    marked = "\n".join("REM " + " ".join(words[k : k + 8]) for k in range(0, len(words), 8))
    foreign = " ".join([*words[:17], "zebra", *words[17:34], "giraffe", *words[34:]])
    far = " ".join([*words[:17], *["zebra"] * 200, *words[17:34], *["zebra"] * 200, *words[34:]])
    copies = " zebra ".join([" ".join(words)] * 9 + [foreign])
    found = scanned(spark, [marked, foreign, far, copies])
    for r in found[:2]:
        assert (r.labels, [(s.label, s.end) for s in r.spans]) == ("mit", [("mit", r.n_words)])
        assert r.score == r.spans[0].score > 0.9
    assert (found[2].labels, found[2].spans) == ("", [])
    spans = [(s.start, s.end) for s in found[3].spans]
    assert len(spans) == 10 and all(a[1] <= b[0] for a, b in zip(spans, spans[1:]))


def test_licences_are_told_apart(spark):
    commons = "This work is licensed under a Creative Commons {} 4.0 International License."
    cases = {
        "Songs released under the title Zebra": "",
        "Licensed under the BSD License": "",
        "Licensed under the Eclipse Public License, Version 2.0": "",
        "Licensed under the Educational Community License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License. You may obtain a copy of the License at": "",
        commons.format("Attribution-ShareAlike"): "cc-by-sa",
        "This Source Code Form is subject to the terms of the Eclipse Public License, v. 2.0": "",
        "Released under the Apache License, Version 2.0": "apache",
        "Released under the MIT License": "mit",
        "the MIT License": "mit",
        "Licensed under the GNU General Public License, version 3": "gpl",
        commons.format("Attribution"): "cc-by",
        commons.format("Attribution-NonCommercial"): "cc-by-nc",
        "Licensed under CC BY-ND 4.0": "",
        # The phrase of a general licence stands in the names of special ones.
        **{text: {"lgpl": "gpl,lgpl", "agpl": "agpl,gpl"}.get(label, label) for label, text in licenses.TEMPLATES},
    }
    found = scanned(spark, list(cases))
    assert [r.labels for r in found] == list(cases.values())
    assert [bool(r.spans) for r in found] == [bool(label) for label in cases.values()]
    assert all((r.score >= licenses.COVERED) == bool(r.spans) for r in found)


def test_matching_statistics_match_brute_force():
    sequences = [[1, 2, 3, 1, 2, 4], [2, 3, 5], [1, 1, 1]]
    automaton = licenses.SuffixAutomaton(sequences)
    stream = [1, 2, 3, 5, 1, 1, 1, 1, 2, 4, 9, 3, 1, 2]
    runs = {tuple(s[a:b]) for s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
    for k, (_, length) in enumerate(automaton.statistics(stream)):
        assert length == max(n for n in range(k + 2) if n == 0 or tuple(stream[k + 1 - n : k + 1]) in runs)


def test_encoding_is_that_of_the_library(edge_docs, edge_rows):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    ranks = {t: k for k, t in enumerate(bpe.read_ranks(path))}
    own = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    encoded = bpe.encode(edge_docs.withColumn("ids", F.lit(1)), path, public_tokenizers.PATTERN)
    found = encoded.select("doc_id", "text", "ids", bpe.decoded(F.col("ids"), path).alias("back")).collect()
    for r in found:
        assert r.ids == own.encode_ordinary(r.text or "")
        assert bytes(r.back) == (r.text or "").encode()
    assert len(found) == len(edge_rows)


def test_the_fold_in_higher_order_functions(spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    tokens = bpe.read_ranks(path)
    words = ["", "a", " the", "zqxjk", "été", "aaaaaa"]
    found = bpe.fold_words(spark.createDataFrame([(w,) for w in words], "word string"), path).collect()
    want = bpe.Folder(tokens).fold([w.encode() for w in words if w])
    assert [r.ids for r in found if r.word] == [x.tolist() for x in want]


def test_empty_tables(no_docs, spark):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    assert minhash.near_duplicates(no_docs).count() == 0
    assert repeats.without_repeats(no_docs).count() == 0
    assert langmodel.score_texts(no_docs, 7, 2).count() == 0
    assert rules.statistics(no_docs).count() == 0
    assert licenses.scan(no_docs).count() == 0
    assert bpe.encode(no_docs, path, public_tokenizers.PATTERN).count() == 0


def test_rows_of_one_id_keep_their_links(spark, edge_rows):
    base, other = (" ".join(f"{c}{k}" for k in range(60)) for c in "ab")
    rows = [(1, base), (1, other), (2, base + " tail"), (3, other + " tail"), (4, other + " x y"), (7, base), (7, "else " * 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("x")).withColumn("rep", F.lit(0))
    found = {(r.doc_id, r.component_id, r.kept) for r in minhash.near_duplicates(docs).collect()}
    assert found == {(1, 1, True), (2, 1, False), (3, 1, False), (4, 1, False), (7, 1, False), (7, 7, True)}


def test_filter_of_ids_lets_all_through(spark):
    wanted = IdFilter.of(spark.range(0, 30_000, 3))
    every = spark.range(30_000).union(spark.createDataFrame([(None,)], "id long"))
    passed = {r.id for r in wanted.passed(every, "id").collect()}
    assert set(range(0, 30_000, 3)) <= passed
    assert None not in passed
    assert len(passed) < 11_000
    assert IdFilter.of(spark.range(0)).passed(every, "id").count() == 0


@pytest.mark.parametrize("hot", [5, 30, repeats.HOT])
def test_passages_in_a_third_of_the_rows(spark, hot):
    """A long passage and a short line between ever new neighbours, in copies that are split."""
    rnd = random.Random(hot)
    passage, line = "".join(rnd.choice("abcdef ") for _ in range(260)), "the same forty bytes stand in many texts "
    rows = []
    for k in range(240):
        own = "".join(rnd.choice("xyz uvw") for _ in range(rnd.randrange(0, 90)))
        rest = "".join(rnd.choice("xyz uvw") for _ in range(rnd.randrange(0, 90)))
        rows.append((k, own + (passage if k % 3 == 0 else line if k % 3 == 1 else "") + rest + (line * 2 if k % 7 == 0 else "")))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(12)
    found = repeats.without_repeats(docs, hot=hot).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in found} == cut_by_hand(rows)
