"""Toxicity: a linear-chain conditional random field over words.

Only documents carry labels, so words are labelled first: a word feature (the word, or its first
bytes) that occurs in far more toxic documents than chance explains, by its counts in all labelled
documents, marks the words that have it, in toxic documents. The field is trained on those words of a
bounded sample with exact forward-backward gradients; each step is one Spark job over the sample,
and only the summed gradient returns. Marginals give the offending spans, and a logistic layer on the marginals of a
document gives its score.

The words of a batch of documents form one chain of 2 x 2 matrices in which the first word of a
document forgets what came before; its prefix products are computed in blocks, side by side.

Cases: null and empty texts have no spans and get the score of a document without any toxic word;
without labels of both kinds all scores are the share of toxic labels (0 without any). Labels that
are null are ignored, of several labels of a document the highest counts. Columns of the input
that are named like new ones are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import stored
from tablestream.llm.idfilter import IdFilter
from tablestream.llm.textarrays import (
    LOWER,
    NOT_BLANK,
    Hashes,
    Words,
    flat,
    per_text,
    per_text_sum,
    slices,
)
from tablestream.session import cut_lineage

BITS = 20
PREFIXES = (3, 4, 5, 6, 7)
NONE = 1 << BITS  # the feature of words too short for a prefix; its weight stays 0
BLOCK = 64
#: Labelled documents of each class that a fit uses at most, the first by a hash of their id.
SAMPLE_PER_CLASS = 1500
SAMPLE_PARTS = 12
STEPS = 14
#: A feature is evidence if at least so many labelled toxic documents have it, if it is so many times
#: as frequent in them as in others, and if no more than so many of all features pass by chance.
LEAST_SEEN, TIMES, BY_CHANCE = 4, 8, 20
NEW = ("toxic_score", "toxic_spans")
#: Text that a task works on at once: each word has several features.
TASK_BYTES = 1 << 19
#: Marginal from which a word counts in the score of its document.
SUSPECT = 0.25


@dataclass
class Model:
    weights: np.ndarray  # of the toxic state, by feature
    bias: float
    chain: np.ndarray  # transition potentials, previous state by row
    layer: np.ndarray  # of the document score
    prior: float | None  # the only score, where there is nothing to learn from


class Sentences:
    """Words of a slice with their feature numbers."""

    def __init__(self, column: pa.Array):
        self.raw, self.offsets = flat(column)
        low = LOWER[self.raw]
        self.words = words = Words(low, self.offsets, NOT_BLANK)
        hashes = Hashes(low)
        whole = hashes(words.start, words.end)
        self.whole = whole
        self.codes = np.empty((len(PREFIXES) + 1, len(words)), np.uint64)
        self.codes[0] = whole
        length = words.end - words.start
        for k, size in enumerate(PREFIXES, 1):
            has = length >= size
            end = np.where(has, words.start + size, words.end)
            part = hashes(words.start, end) * np.uint64(2 * size + 1)
            self.codes[k] = np.where(has, part, 0)
        self.features = (self.codes >> np.uint64(64 - BITS)).astype(np.int32)
        self.features[self.codes == 0] = NONE


def _products(matrices: np.ndarray) -> np.ndarray:
    """Products of each block of matrices, scaled; matrices: (2, 2, blocks, BLOCK)."""
    out = matrices[..., 0].copy()
    for k in range(1, matrices.shape[-1]):
        m = matrices[..., k]
        out = np.stack(
            [
                np.stack([out[i, 0] * m[0, j] + out[i, 1] * m[1, j] for j in (0, 1)])
                for i in (0, 1)
            ]
        )
        out /= out.max(axis=(0, 1))
    return out


def forward_backward(
    potential: np.ndarray, chain: np.ndarray, first: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scaled forward and backward vectors (2, n) and the matrices (2, 2, n) they belong to.

    ``potential``: log potential of state 1; ``chain``: transition potentials; ``first``: whether a
    word is the first of its document.
    """
    n = len(potential)
    blocks = -(-n // BLOCK)
    high = np.clip(potential, -30, 30)
    emit = np.stack([np.exp(-np.maximum(high, 0)), np.exp(np.minimum(high, 0))])
    step = np.exp(chain)
    matrices = np.zeros((2, 2, blocks * BLOCK))
    matrices[0, 0, n:] = matrices[1, 1, n:] = 1.0
    for i in (0, 1):
        for j in (0, 1):
            matrices[i, j, :n] = np.where(first, 1.0, step[i, j]) * emit[j]
    cut = matrices.reshape(2, 2, blocks, BLOCK)
    whole = _products(cut).tolist()
    ahead, behind = np.empty((2, blocks)), np.empty((2, blocks))
    a, b = 0.5, 0.5
    for k in range(blocks):
        ahead[0, k], ahead[1, k] = a, b
        c, d = a * whole[0][0][k] + b * whole[1][0][k], a * whole[0][1][k] + b * whole[1][1][k]
        a, b = c / (c + d), d / (c + d)
    a, b = 0.5, 0.5
    for k in range(blocks - 1, -1, -1):
        behind[0, k], behind[1, k] = a, b
        c, d = whole[0][0][k] * a + whole[0][1][k] * b, whole[1][0][k] * a + whole[1][1][k] * b
        a, b = c / (c + d), d / (c + d)
    forward, backward = np.empty((2, blocks, BLOCK)), np.empty((2, blocks, BLOCK))
    state = ahead
    for k in range(BLOCK):
        m = cut[..., k]
        state = np.stack([state[0] * m[0, j] + state[1] * m[1, j] for j in (0, 1)])
        state /= state.sum(axis=0)
        forward[..., k] = state
    state = behind
    for k in range(BLOCK - 1, -1, -1):
        backward[..., k] = state
        m = cut[..., k]
        state = np.stack([m[i, 0] * state[0] + m[i, 1] * state[1] for i in (0, 1)])
        state /= state.sum(axis=0)
    return forward.reshape(2, -1)[:, :n], backward.reshape(2, -1)[:, :n], matrices[..., :n]


def marginals(words: Sentences, model: Model) -> np.ndarray:
    """Probability of the toxic state for each word."""
    if not len(words.words):
        return np.empty(0)
    first = np.zeros(len(words.words), bool)
    first[words.words.bounds[:-1][words.words.counts > 0]] = True
    potential = model.weights[words.features].sum(axis=0) + model.bias
    forward, backward, _ = forward_backward(potential, model.chain, first)
    both = forward * backward
    return both[1] / both.sum(axis=0)


def summary(p: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """What the document score sees of the marginals: the expected number of toxic words, and the
    chance of at least one and of at least two, words taken as independent."""
    # Words that are hardly suspect don't add up, however long the text.
    rest = np.where(p >= SUSPECT, np.minimum(p, 1 - 1e-9), 0.0)
    total = per_text_sum(rest, bounds)
    none = np.exp(per_text_sum(np.log1p(-rest), bounds))
    one = none * per_text_sum(rest / (1 - rest), bounds)
    return np.stack([np.ones(len(total)), np.log1p(total), 1 - none, np.clip(1 - none - one, 0, 1)])


def labelled(docs: DataFrame, labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """All labelled documents: doc_id, text, y and ``picked``, whether the fit uses them, which holds
    for at most ``per_class`` of each class. Equal texts and texts with the same smallest hash of
    three words, mostly near copies, count once, by their least id."""
    wanted = F.when(F.col(label) > 0, 1).when(F.col(label) <= 0, 0)
    known = labels.select("doc_id", wanted.alias("y")).filter("doc_id IS NOT NULL AND y IS NOT NULL")
    known = known.groupBy("doc_id").agg(F.max("y").alias("y"))

    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    lets = IdFilter.of(known.select(F.col("doc_id").cast("long"))).lets

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch.filter(lets(batch.column("doc_id")))], "text", TASK_BYTES):
                words = Sentences(part.column("text"))
                least = per_text(np.minimum, *words.words.shingles(words.whole, 3), 0).astype(np.int64)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(least)], names=["doc_id", "key"])

    # Only ids and keys are dealt to find the documents; then their texts, once.
    keyed = docs.mapInArrow(keys, "doc_id long, key long").join(known, "doc_id")
    single = stored(keyed.groupBy("key", "y").agg(F.min("doc_id").alias("doc_id")).select("doc_id", "y").distinct())
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = [single.filter(F.col("y") == y).orderBy(*order).limit(per_class) for y in (0, 1)]
    picked = chosen[0].unionByName(chosen[1]).select("doc_id", F.lit(True).alias("picked"))
    single = single.join(F.broadcast(picked), "doc_id", "left")  # at most 2 * per_class rows
    single = stored(single.withColumn("picked", F.coalesce("picked", F.lit(False))))
    texts = IdFilter.of(single.select("doc_id")).passed(docs, "doc_id")
    return stored(texts.join(single, "doc_id"))


def _gradients(sample: DataFrame, task) -> tuple[np.ndarray, np.ndarray]:
    """Run ``task`` (Sentences, labels -> gradient by feature, gradient of the chain) over the sample
    and add up. Only features with a gradient travel."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, chain = np.zeros(NONE + 1), np.zeros(5)
        for part in slices(batches, "text", TASK_BYTES):
            found = task(Sentences(part.column("text")), part.column("y").to_numpy())
            weights += found[0]
            chain += found[1]
        at = np.flatnonzero(weights).astype(np.int32)
        parts = [at.tobytes(), weights[at].astype(np.float32).tobytes(), chain.tobytes()]
        yield pa.RecordBatch.from_arrays([pa.array([x], pa.binary()) for x in parts], names=["at", "by", "chain"])

    weights, chain = np.zeros(NONE + 1), np.zeros(5)
    for row in sample.mapInArrow(run, "at binary, by binary, chain binary").collect():  # one a partition
        weights[np.frombuffer(row["at"], np.int32)] += np.frombuffer(row["by"], np.float32)
        chain += np.frombuffer(row["chain"])
    return weights, chain


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", per_class: int = SAMPLE_PER_CLASS) -> Model:
    """Learn from at most ``per_class`` documents of each class among the rows of ``labels``."""
    wanted = F.when(F.col(label) > 0, 1).when(F.col(label) <= 0, 0)
    totals = labels.filter("doc_id IS NOT NULL").groupBy(wanted.alias("y")).count().filter("y IS NOT NULL").collect()
    totals = {row["y"]: row["count"] for row in totals}
    blank = Model(np.zeros(NONE + 1), 0.0, np.zeros((2, 2)), np.zeros(4), None)
    if len(totals) < 2:
        blank.prior = float(1 in totals)
        return blank
    pool = labelled(docs, labels, label, per_class)
    sample = cut_lineage(pool.filter("picked").repartition(SAMPLE_PARTS))
    have = {row["y"]: row["count"] for row in sample.groupBy("y").count().collect()}
    if len(have) < 2:
        blank.prior = totals[1] / sum(totals.values())
        return blank
    every = {row["y"]: row["count"] for row in pool.groupBy("y").count().collect()}

    def documents_with(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TASK_BYTES):
            words = Sentences(part.column("text"))
            owner = np.broadcast_to(words.words.text, words.codes.shape).ravel()
            codes = words.codes.ravel()
            order = np.lexsort((owner, codes))
            codes, owner = codes[order], owner[order]
            new = np.ones(len(codes), bool)
            new[1:] = (codes[1:] != codes[:-1]) | (owner[1:] != owner[:-1])
            toxic = part.column("y").to_numpy()[owner[new]]
            fits = part.column("picked").to_numpy(zero_copy_only=False)[owner[new]] & (toxic > 0)
            codes, first = np.unique(codes[new], return_index=True)
            seen = np.diff(np.append(first, len(toxic)))
            hits, fits = (np.add.reduceat(x.astype(np.int64), first) if len(first) else seen for x in (toxic, fits))
            yield pa.RecordBatch.from_arrays(
                [pa.array(codes.astype(np.int64)), *(pa.array(x, pa.int64()) for x in (hits, seen, fits))],
                names=["code", "toxic", "seen", "fits"],
            )

    rate = every[1] / sum(every.values())
    toxic, seen = F.col("toxic"), F.col("seen")
    counted = (
        pool.mapInArrow(documents_with, "code long, toxic long, seen long, fits long")
        .groupBy("code")
        .agg(F.sum("toxic").alias("toxic"), F.sum("seen").alias("seen"), F.sum("fits").alias("fits"))
        .filter((F.col("code") != 0) & (seen >= LEAST_SEEN))
    )
    counted = stored(counted)
    # As many toxic documents have a feature by chance with a probability of exp(-seen * divergence)
    # at most; of all features tested, few may pass by chance.
    bound = float(np.log(max(1, counted.count() / BY_CHANCE)))
    share = toxic / seen
    divergence = share * F.log(share / rate) + F.when(toxic < seen, (1 - share) * F.log((1 - share) / (1 - rate))).otherwise(0.0)
    evidence = counted.filter(
        (toxic >= LEAST_SEEN)
        & (F.col("fits") > 0)
        & (toxic * every[0] >= TIMES * (seen - toxic) * every[1])
        & (seen * divergence >= bound)
    )
    # No more than the features of the sample's toxic documents.
    evidence = np.array(sorted(row["code"] for row in evidence.collect()), np.int64).view(np.uint64)

    def truth(words: Sentences, y: np.ndarray) -> np.ndarray:
        return np.isin(words.codes, evidence).any(axis=0) & (y[words.words.text] == 1)

    model = blank

    def gradient(words: Sentences, y: np.ndarray) -> list[np.ndarray]:
        d_weights, d_chain = np.zeros(NONE + 1), np.zeros(5)
        n = len(words.words)
        if n:
            tag = truth(words, y).astype(np.int64)
            first = np.zeros(n, bool)
            first[words.words.bounds[:-1][words.words.counts > 0]] = True
            potential = model.weights[words.features].sum(axis=0) + model.bias
            forward, backward, matrices = forward_backward(potential, model.chain, first)
            both = forward * backward
            p = both[1] / both.sum(axis=0)
            error = tag - p
            active = np.abs(error) > 1e-3
            for row in words.features[:, active]:
                d_weights += np.bincount(row, error[active], NONE + 1)
            d_chain[4] = error.sum()
            inner = np.flatnonzero(~first)
            joint = forward[:, None, inner - 1] * matrices[..., inner] * backward[None, :, inner]
            joint /= joint.sum(axis=(0, 1))
            seen_pairs = np.bincount(2 * tag[inner - 1] + tag[inner], minlength=4)
            d_chain[:4] = seen_pairs - joint.sum(axis=2).ravel()
        return [d_weights, d_chain]

    squares = [np.full(NONE + 1, 1e-6), np.full(5, 1e-6)]
    model.bias = -3.0
    for _ in range(STEPS):
        grads = list(_gradients(sample, gradient))
        grads[0] -= 0.05 * model.weights
        grads[0][NONE] = 0
        grads[1] -= 0.05 * np.append(model.chain.ravel(), model.bias)
        for s, g in zip(squares, grads, strict=True):
            s += g * g
        model.weights = (model.weights + 0.8 * grads[0] / np.sqrt(squares[0])).astype(np.float32)
        change = 0.3 * grads[1] / np.sqrt(squares[1])
        model.chain = model.chain + change[:4].reshape(2, 2)
        model.bias += change[4]

    # The layer sees the class shares of the labels, not those of the sample.
    def read_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, "text", TASK_BYTES):
            words = Sentences(part.column("text"))
            x = summary(marginals(words, model), words.words.bounds)
            yield pa.RecordBatch.from_arrays([pa.array(list(x.T)), part.column("y")], names=["x", "y"])

    rows = sample.mapInArrow(read_out, "x array<double>, y int").collect()  # the bounded sample
    x, y = np.array([row["x"] for row in rows]), np.array([row["y"] for row in rows])
    share = np.where(y == 1, totals[1] / have[1], totals[0] / have[0])
    share = share / share.mean()
    layer = np.zeros(x.shape[1])
    for _ in range(30):
        q = 1 / (1 + np.exp(-np.clip(x @ layer, -30, 30)))
        hessian = (x * (share * q * (1 - q))[:, None]).T @ x + 0.1 * np.eye(len(layer))
        layer = layer + np.linalg.solve(hessian, x.T @ (share * (y - q)) - 0.1 * layer)
    model.layer = layer
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add ``toxic_score`` (0 to 1) and ``toxic_spans``: character ranges of offending words."""
    names = list(NEW)
    docs = docs.drop(*names)
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, text, TASK_BYTES):
            words = Sentences(part.column(text))
            p = marginals(words, model)
            if model.prior is None:
                x = summary(p, words.words.bounds)
                scores = 1 / (1 + np.exp(-np.clip(model.layer @ x, -30, 30)))
            else:
                scores = np.full(part.num_rows, model.prior)
            spans: list[list] = [[] for _ in range(part.num_rows)]
            hits = np.flatnonzero(p >= 0.5)
            start, end, at = words.words.start, words.words.end, words.words.text
            # Characters before a byte: bytes that don't continue a code point.
            chars = np.concatenate([[0], np.cumsum((words.raw & 0xC0) != 0x80)])
            last = -2
            for k in hits.tolist():
                base = chars[words.offsets[at[k]]]
                if k == last + 1 and spans[at[k]] and at[k] == at[last]:
                    spans[at[k]][-1]["end"] = int(chars[end[k]] - base)
                else:
                    spans[at[k]].append({"start": int(chars[start[k]] - base), "end": int(chars[end[k]] - base)})
                last = k
            yield pa.RecordBatch.from_arrays(
                [*part.columns, pa.array(scores, pa.float64()), pa.array(spans, kind)],
                names=[*part.schema.names, *names],
            )

    from pyspark.sql.types import StructType

    added = StructType.fromDDL("toxic_score double, toxic_spans array<struct<start:int,end:int>>")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))
