"""Personal data: patterns against plain regular expressions, the field against enumeration and full
decoding, and accuracy on sentences it has not seen."""

import hashlib
import itertools
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tablestream.llm import pii, queries  # noqa: F401
from tablestream.llm.registry import QUERIES
from tablestream.llm.textarrays import flat

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def check_digit_fits(digits):
    total = 0
    for k, d in enumerate(reversed(digits)):
        d = int(d) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def by_hand(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            good = {
                "email": True,
                "ip": all(int(p) <= 255 for p in m.group().split(".")) if kind == "ip" else True,
                "card": 16 <= len(digits) <= 19 and check_digit_fits(digits),
                "phone": 8 <= len(digits) <= 15,
            }[kind]
            if good:
                out.append((kind, m.start(), m.end()))
    return out


def some_texts():
    rnd = random.Random(4)
    pieces = ["a@b.c", "x.y@", "@z.de", "a@b@c.d.e", "@", "@@", "é.q@r-s.t", "1.2.3.4", "1.2.3.4.5", "300.1.1.1", "1.2.3",
              "0001.02.3.255", "4111 1111 1111 1111", "4111-1111-1111-1112", "4111111111111111", "123", "+1 (918) 555-3922",
              "+12", "+1 2 3 4 5 6 7 8 9 0 1 2 3 4 5 6 7", "+", "..", "word", "été", " ", "\n", "-", "(", "9" * 40, "日本", "."]
    texts = ["".join(rnd.choice(pieces) + rnd.choice(["", " ", " "]) for _ in range(rnd.randrange(1, 14))) for _ in range(600)]
    return [*texts, "", "a" * 300 + "@" + "b" * 200 + ".c", "a" * 64 + "@b.c", "x" + "é" * 3 + "@b.c", "7" * 30_000, "1." * 20_000]


def test_patterns_match_regular_expressions():
    for text in some_texts():
        if len(text) < 5000:
            assert pii.pattern_spans(text) == by_hand(text), text
        else:
            pii.pattern_spans(text)  # in time that grows with the text


@pytest.fixture(scope="module")
def model(spark):
    return pii.fit(pii.examples(spark))


def tokens_of(texts):
    return pii.Tokens(*flat(pa.array(texts)))


def test_tokens_and_neighbours():
    tokens = tokens_of(["Ab1 é\n--", None, "", "x"])
    assert tokens.start.tolist() == [0, 2, 4, 7, 8, 9]
    assert tokens.text.tolist() == [0, 0, 0, 0, 0, 3]
    assert tokens.near(np.arange(1, 7), 1).tolist() == [2, 3, 4, 5, 0, 0]
    assert tokens.near(np.arange(1, 7), -2).tolist() == [0, 0, 1, 2, 3, 0]
    assert tokens.near(np.arange(1, 7), 9).tolist() == [0] * 6


def test_forward_backward_and_viterbi_match_enumeration():
    rnd = np.random.default_rng(3)
    labels = 3
    lengths = np.array([4, 1, 3])
    scores, chain = rnd.normal(size=(3, 4, labels)) * 2, rnd.normal(size=(labels, labels))
    marginals, expected, total = pii.forward_backward(scores, chain, lengths)
    pairs = np.zeros((labels, labels))
    for k, n in enumerate(lengths):
        paths = list(itertools.product(range(labels), repeat=int(n)))
        value = np.array(
            [sum(scores[k, t, y] for t, y in enumerate(p)) + sum(chain[a, b] for a, b in itertools.pairwise(p)) for p in paths]
        )
        weight = np.exp(value - value.max())
        assert total[k] == pytest.approx(np.log(weight.sum()) + value.max())
        weight /= weight.sum()
        for p, w in zip(paths, weight, strict=True):
            for a, b in itertools.pairwise(p):
                pairs[a, b] += w
        for t in range(int(n)):
            for y in range(labels):
                assert marginals[k, t, y] == pytest.approx(sum(w for p, w in zip(paths, weight, strict=True) if p[t] == y))
        assert marginals[k, int(n) :].sum() == 0
    assert expected == pytest.approx(pairs)

    flat_scores = np.concatenate([scores[k, :n] for k, n in enumerate(lengths)])
    starts = np.array([0, 4, 5])
    before, after = np.array([True, False, True]), np.array([False, True, True])
    found = pii.viterbi(flat_scores, chain, starts, starts + lengths, before, after)
    for k, n in enumerate(lengths):
        best = max(
            itertools.product(range(labels), repeat=int(n)),
            key=lambda p, k=k: sum(scores[k, t, y] for t, y in enumerate(p))
            + sum(chain[a, b] for a, b in itertools.pairwise([0] * int(before[k]) + list(p) + [0] * int(after[k]))),
        )
        assert tuple(found[starts[k] : starts[k] + n]) == best


def test_settled_tokens_do_not_change_the_best_path(model):
    texts = some_texts()[:300] + [t for t, _ in (pii._redrawn(line, np.random.default_rng(8)) for line in pii.LINES)]
    tokens = tokens_of(texts)
    scores = model.potentials(tokens, model.known(tokens.words())).astype(np.float64)
    full = tokens.bounds[:-1] < tokens.bounds[1:]
    starts, ends = tokens.bounds[:-1][full], tokens.bounds[1:][full]
    never = np.zeros(len(starts), bool)
    want = pii.viterbi(scores, model.chain, starts, ends, never, never)
    assert (pii.decoded(tokens, model) == want).all()


UNSEEN = """
please ring {phone|(303) 555-1234} tonight
my number is {phone|415-555-2671}, call any time
fax: {phone|212.555.0187}
zzz {email|foo.bar at gmail dot com} yes
{email|qua.si at somewhere dot org}
hit {ip|10[.]1[.]2[.]3} hard
they saw {email|bob(at)corp.example.com} there
amex {card|3714 496353 98431} was used
Les aux {phone|(628) 555-9911}, et
""".strip().split("\n")
CLEAN = ["Les aux 4.0.", "page 12-14 of 300", "on 2023-01-02 at 12:30 we saw 14 of 20", "see v1.2.3-45", "x = 12345678",
         "a 12 b 13 c 14", "Is this the way. On and of the in.", "The at and dot of it", "1,200 or 3.5 %", "", None]


def test_unseen_sentences(spark, model):
    lines = [pii._redrawn(line, np.random.default_rng(k)) for k, line in enumerate(UNSEEN * 4)]
    rows = [(k, text) for k, (text, _) in enumerate(lines)] + [(1000 + k, text) for k, text in enumerate(CLEAN)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: [tuple(s) for s in r.pii_spans] for r in pii.find(docs, model).collect()}
    hits = sum(set(spans) <= set(found[k]) for k, (_, spans) in enumerate(lines))
    assert hits >= 0.85 * len(lines)
    assert [found[1000 + k] for k in range(len(CLEAN))] == [[]] * len(CLEAN)


def test_spans_of_documents(spark, model, edge_rows, no_docs):
    rows = [*((r[0], r[1]) for r in edge_rows), *((500 + k, t) for k, t in enumerate(some_texts()[:200]))]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("pii_spans", F.lit("old")).repartition(3)
    found = pii.find(docs, model)
    assert found.columns == ["doc_id", "text", "pattern_spans", "pii_spans"]
    found = found.collect()
    want = Counter((d, t, tuple(by_hand(t or ""))) for d, t in rows)
    assert Counter((r.doc_id, r.text, tuple(tuple(s) for s in r.pattern_spans)) for r in found) == want
    for r in found:
        every = [tuple(s) for s in r.pii_spans]
        assert {tuple(s) for s in r.pattern_spans} <= set(every)
        assert every == sorted(every, key=lambda s: (pii.KINDS.index(s[0]), s[1], s[2]))
    assert pii.find(no_docs, model).count() == 0


def test_labelled_tables(spark):
    empty = spark.createDataFrame([], f"text string, spans {pii.SPANS}")
    docs = spark.createDataFrame([("mail a@b.de or (918) 555-3922",)], "text string")
    row = pii.find(docs, pii.fit(empty)).first()
    assert [tuple(s) for s in row.pii_spans] == [("email", 5, 11)]
    with pytest.raises(ValueError):
        pii.fit(empty.unionByName(spark.range(pii.MOST_LABELLED + 1).select(F.lit("x").alias("text"), F.lit(None).cast(pii.SPANS).alias("spans"))))


def test_query_digests(spark):
    found = QUERIES["op12_personal_data"](spark, "/root/testdata/sf0.001").collect()
    texts = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    have = {r.doc_id: ((r.n_email, r.n_ip, r.n_card, r.n_phone), r.base_sha256) for r in found}
    for r in texts:
        spans = by_hand(r.text or "")
        digest = hashlib.sha256(",".join(":".join(map(str, s)) for s in spans).encode()).hexdigest()
        assert have[r.doc_id] == (tuple(sum(s[0] == kind for s in spans) for kind in pii.KINDS), digest)
    assert len(found) == len(texts)
