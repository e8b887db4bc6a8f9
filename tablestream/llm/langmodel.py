"""Language-model scores from a hashed maximum-entropy model with a class-factored softmax.

A word's probability is that of its class after the words before it, times its own within the class.
Classes come from clustering: the ends of a word name one of 2048 keys, and keys that follow similar
words share a class, so any word has one, seen or not. The class model is a softmax over sums of
weights of hashed features: the word before, the word before that (a skip), and the two classes
before. Within a class the same features choose among hashed groups of its members, in a binary tree:
each node is a logistic model over hashed weights of feature, class and node, and starts at the
shares of the words below it. Within a group words have their add-one share of its training words,
with one place for the unknown. Tables and groups grow with the root of the training tokens.

Training goes over all training documents once, in rounds. In each round every partition takes
gradient steps over its share of documents from the weights of the round before; the changes are
averaged by tokens, in a tree of bounded sums. Word counts are exact and cover all training rows:
each block of documents sends its distinct words by hash range, and gets their counts back.

Cases: null and empty texts are one token, the end; a null id counts as '' where rows are set
aside; without training rows all counts are 0 and words have equal classes.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.blocks import opened, pack, rows
from tablestream.llm.common import stored
from tablestream.llm.textarrays import LOWER, NOT_BLANK, Hashes, Words, mixed, per_text_sum

KEYS, CONTEXTS, CLASSES = 2048, 64, 16  # class 0 is the end of a text
PAIRS = CLASSES * CLASSES
LEAST_ROWS, LEAST_BITS, LEAST_TABLE = 13, 6, 16
ROUNDS, BATCH, RATE = 3, 8192, 0.3
#: Training tokens of a task of a round for each weight of the trees, so that what tasks send stays
#: in proportion to the input.
TOKENS_A_WEIGHT = 16
BUCKET_BYTES, LEAST_BUCKETS = 4 << 20, 48
SLICES, FAN = 16, 32
START = np.uint64(0x1234567)


@dataclass
class Sizes:
    """Sizes that grow with the root of the training tokens."""

    rows: int  # weights of one hashed feature of the class model
    bits: int  # levels of the tree over the members of a class
    table: int  # weights of all trees

    @classmethod
    def of(cls, tokens: int) -> Sizes:
        root = (max(1, tokens).bit_length() - 1) // 2
        return cls(1 << max(LEAST_ROWS, root), max(LEAST_BITS, root - 3), 1 << max(LEAST_TABLE, root + 5))

    def leaf(self, hashes: np.ndarray) -> np.ndarray:
        """Group of each word; neighbours in the order of hashes share one."""
        return (hashes >> np.uint64(64 - self.bits)).astype(np.int64)


class Tokens:
    """Words of a block, with their hashes, keys and positions."""

    def __init__(self, row: dict):
        raw, offsets = opened(row)
        raw = LOWER[raw]
        self.words = words = Words(raw, offsets, NOT_BLANK)
        self.hashes = Hashes(raw)(words.start, words.end)
        ends = [words.start, np.minimum(words.start + 1, words.end - 1), np.maximum(words.end - 2, words.start), words.end - 1]
        code = np.zeros(len(words), np.uint64)
        for at in ends:
            code = (code << np.uint64(8)) | raw[at].astype(np.uint64)
        self.keys = (mixed(code) % np.uint64(KEYS)).astype(np.int64)
        self.crc = np.array([zlib.crc32(b"" if i is None else str(i).encode()) for i in row["ids"]], np.int64)
        # Each text's words and then its end, in one row of places.
        n = words.texts
        self.bounds = words.bounds + np.arange(n + 1)
        self.text = np.repeat(np.arange(n), words.counts + 1)
        self.end = np.zeros(len(self.text), bool)
        self.end[self.bounds[1:] - 1] = True

    def before(self, values: np.ndarray, start, step: int) -> np.ndarray:
        """The value ``step`` places before each place of its text, ``start`` where there is none."""
        full = np.empty(len(self.text), values.dtype)
        full[~self.end] = values
        full[self.end] = start
        out = np.full(len(full), start, values.dtype)
        out[step:] = full[:-step]
        first = np.arange(len(full)) - self.bounds[self.text]
        out[first < step] = start
        return out

    def classes(self, of_key: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.text), np.int64)
        out[~self.end] = of_key[self.keys]
        return out

    def features(self, of_key: np.ndarray, size: int) -> np.ndarray:
        one, two = self.before(self.hashes, START, 1), self.before(self.hashes, START, 2)
        word_classes = of_key[self.keys]
        pair = self.before(word_classes, 0, 1) * CLASSES + self.before(word_classes, 0, 2)
        shift = np.uint64(64 - size.bit_length() + 1)
        return np.stack(
            [
                (mixed(one) >> shift).astype(np.int64),
                size + (mixed(two ^ np.uint64(0x5555)) >> shift).astype(np.int64),
                2 * size + pair,
            ]
        )

    def members(self, of_key: np.ndarray, use: np.ndarray) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
        """Class and hash of each word of the places in use, and the codes of its features there."""
        use = use & ~self.end
        one, two = self.before(self.hashes, START, 1)[use], self.before(self.hashes, START, 2)[use]
        word_classes = of_key[self.keys]
        pair = (self.before(word_classes, 0, 1) * CLASSES + self.before(word_classes, 0, 2))[use].astype(np.uint64)
        inside = use[~self.end]
        own = word_classes[inside]
        of_class = mixed(np.arange(1, CLASSES + 1, dtype=np.uint64))[own]
        codes = [one ^ of_class, two ^ (of_class + np.uint64(1)), pair ^ (of_class + np.uint64(2))]
        return own, self.hashes[inside], [(mixed(c) >> np.uint64(32)).astype(np.uint32) for c in codes]


class Trees:
    """A binary tree over the groups of members of each class. ``cell_words`` has the add-one total of
    each class and group; without weights a group has its share of them."""

    def __init__(self, sizes: Sizes, cell_words: np.ndarray):
        self.bits, self.mask = sizes.bits, np.uint32(sizes.table - 1)
        total = np.zeros((CLASSES, 2 << sizes.bits))
        total[:, 1 << sizes.bits :] = cell_words
        for level in range(sizes.bits - 1, -1, -1):
            at = np.arange(1 << level, 2 << level)
            total[:, at] = total[:, 2 * at] + total[:, 2 * at + 1]
        at = np.arange(1, 1 << sizes.bits)
        prior = np.zeros((CLASSES, 1 << sizes.bits), np.float32)
        prior[:, 1:] = np.log(total[:, 2 * at + 1] / total[:, 2 * at])
        self.prior = prior.reshape(-1)
        self.salt = (mixed(np.arange(1, (1 << sizes.bits) + 1, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)

    def levels(self, weights: np.ndarray, own: np.ndarray, leaf: np.ndarray, codes: list) -> Iterator[tuple]:
        """For each level from the root: places of the weights, side taken, log odds of the right."""
        full, first = leaf | (1 << self.bits), own << self.bits
        for level in range(self.bits):
            node = full >> (self.bits - level)
            salt = self.salt[node]
            places = [(code ^ salt) & self.mask for code in codes]
            x = self.prior[first + node]
            for at in places:
                x += weights[at]
            yield places, (full >> (self.bits - level - 1)) & 1, np.clip(x, -30, 30, out=x)

    def log_chance(self, weights: np.ndarray, own: np.ndarray, leaf: np.ndarray, codes: list) -> np.ndarray:
        """Natural logarithm of the chance of each word's group within its class."""
        inverse = np.ones(len(own))
        for _, side, x in self.levels(weights, own, leaf, codes):
            inverse *= 1 + np.exp(np.where(side, -x, x))
        return -np.log(inverse)

    def gradient(self, weights: np.ndarray, own: np.ndarray, leaf: np.ndarray, codes: list) -> np.ndarray:
        at, off = [], []
        for places, side, x in self.levels(weights, own, leaf, codes):
            at.extend(places)
            off.extend([1 / (1 + np.exp(-x)) - side.astype(np.float32)] * len(places))
        return np.bincount(np.concatenate(at), np.concatenate(off), len(weights)).astype(np.float32)


@dataclass
class Model:
    of_key: np.ndarray
    weights: np.ndarray
    inside: np.ndarray  # weights of the trees
    cell_words: np.ndarray  # add-one total of each class and group
    tokens: int
    distinct: int
    ends: int


def _counted(batches: Iterator[pa.RecordBatch], count: int, train: Callable) -> Iterator[pa.RecordBatch]:
    follows, used = np.zeros(KEYS * CONTEXTS, np.int64), False
    ends = 0
    for row in rows(batches):
        used = True
        tokens = Tokens(row)
        learned = train(tokens.crc)
        ends += int(learned.sum())
        own = learned[tokens.words.text]
        words, first, place = np.unique(tokens.hashes, return_index=True, return_inverse=True)
        counts = np.bincount(place[own], minlength=len(words)).astype(np.uint32)
        keys = tokens.keys[first].astype(np.uint16)
        bucket = ((words >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)
        kinds, cuts = np.unique(bucket, return_index=True)
        cuts = np.append(cuts, len(words))
        parts = [
            (words[a:b].tobytes(), counts[a:b].tobytes(), keys[a:b].tobytes())
            for a, b in zip(cuts[:-1], cuts[1:], strict=True)
        ]
        yield _rows(kinds.astype(np.int64), row["block"], parts, None)
        context = tokens.before(tokens.keys, KEYS, 1)[~tokens.end] % CONTEXTS
        follows += np.bincount((tokens.keys * CONTEXTS + context)[own], minlength=len(follows))
    if used:
        yield _rows(np.array([-1]), ends, [(b"", b"", b"")], follows.tolist())


def _rows(kinds: np.ndarray, block: int, parts: list, follows: list | None) -> pa.RecordBatch:
    words, counts, keys = zip(*parts, strict=True) if parts else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [
            pa.array(kinds, pa.int64()), pa.array(np.full(len(kinds), block), pa.int64()),
            pa.array(words, pa.binary()), pa.array(counts, pa.binary()), pa.array(keys, pa.binary()),
            pa.array([follows] * len(kinds), pa.list_(pa.int64())),
        ],
        names=["bucket", "block", "words", "counts", "keys", "follows"],
    )


def _merged(table: pa.Table, of_key: np.ndarray, sizes: Sizes) -> pa.Table:
    """Counts of all words of a hash range, for each block that sent some, and sums by class and group."""
    words = [np.frombuffer(x, np.uint64) for x in table.column("words").to_pylist()]
    lengths = [len(x) for x in words]
    distinct, first, place = np.unique(np.concatenate(words), return_index=True, return_inverse=True)
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table.column("counts").to_pylist()])
    keys = np.concatenate([np.frombuffer(x, np.uint16) for x in table.column("keys").to_pylist()])[first]
    totals = np.bincount(place, counts, len(distinct)).astype(np.int64)
    back = [x.tobytes() for x in np.split(totals[place], np.cumsum(lengths)[:-1])]
    cells, cell = np.unique((of_key[keys] << sizes.bits) | sizes.leaf(distinct), return_inverse=True)
    number, kinds = np.bincount(cell, totals, len(cells)), np.bincount(cell[totals > 0], minlength=len(cells))
    bucket = table.column("bucket").to_pylist()
    out = {
        "bucket": [*bucket, bucket[0]], "block": [*table.column("block").to_pylist(), None],
        "totals": [*back, None],
        "cells": [*[None] * len(back), cells.tolist()],
        "number": [*[None] * len(back), number.astype(np.int64).tolist()],
        "kinds": [*[None] * len(back), kinds.tolist()],
    }
    kind = pa.list_(pa.int64())
    return pa.table(
        out,
        schema=pa.schema(
            [("bucket", pa.int64()), ("block", pa.int64()), ("totals", pa.binary()), ("cells", kind), ("number", kind), ("kinds", kind)]
        ),
    )


def _by_place(df: DataFrame, name: str, size: int) -> np.ndarray:
    """The sum of an array column over all rows, place by place."""
    out = np.zeros(size, np.int64)
    summed = df.select(F.posexplode(name).alias("at", "n")).filter("n != 0").groupBy("at").agg(F.sum("n").alias("n"))
    for row in summed.collect():  # at most ``size`` rows
        out[row["at"]] = row["n"]
    return out


def clustered(follows: np.ndarray, number: np.ndarray) -> np.ndarray:
    """Class of each key: k-means over what words come before, by cosine, weighted by words."""
    share = follows.reshape(KEYS, CONTEXTS) + 0.01
    back = share.sum(axis=0) / share.sum()
    signal = np.sqrt(share / share.sum(axis=1, keepdims=True)) - np.sqrt(back)
    signal /= np.linalg.norm(signal, axis=1, keepdims=True) + 1e-12
    weight = np.sqrt(number + 0.0)
    order = np.argsort(-number, kind="stable")
    centres = [signal[order[0]]]
    for _ in range(CLASSES - 2):  # far from the centres so far, among the frequent
        near = np.max(signal @ np.array(centres).T, axis=1)
        centres.append(signal[np.argmax((1.001 - near) * weight)])
    centres = np.array(centres)
    for _ in range(20):
        own = np.argmax(signal @ centres.T, axis=1)
        for c in range(len(centres)):
            total = (signal * weight[:, None])[own == c].sum(axis=0)
            if np.linalg.norm(total) > 0:
                centres[c] = total / np.linalg.norm(total)
    return np.argmax(signal @ centres.T, axis=1) + 1


def _logits(weights: np.ndarray, features: np.ndarray) -> np.ndarray:
    x = weights[features[0]] + weights[features[1]]
    x += weights[features[2]]
    x += weights[-1]
    x -= x.max(axis=1, keepdims=True)
    return x


def _gradient_steps(
    batches: Iterator[pa.RecordBatch], weights: np.ndarray, inside: np.ndarray, trees: Trees, of_key: np.ndarray,
    sizes: Sizes, train: Callable, turn: int,
) -> Iterator[pa.RecordBatch]:
    own, squares, seen = weights.copy(), np.full((len(weights), 1), 1e-3, np.float32), 0
    own_inside, squares_inside, batch = inside.copy(), np.ones(len(inside), np.float32), max(BATCH, sizes.table // 8)
    for row in rows(batches):
        tokens = Tokens(row)
        learned = train(tokens.crc) & ((tokens.crc >> 8) % ROUNDS == turn)
        use = learned[tokens.text]
        features, truth = tokens.features(of_key, sizes.rows)[:, use], tokens.classes(of_key)[use]
        for a in range(0, len(truth), BATCH):
            f, y = features[:, a : a + BATCH], truth[a : a + BATCH]
            p = np.exp(_logits(own, f))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(y)), y] -= 1
            seen += len(y)
            for some in (*f, np.full(len(y), len(weights) - 1)):
                order = np.argsort(some, kind="stable")
                at, first = np.unique(some[order], return_index=True)
                change = np.add.reduceat(p[order], first, axis=0)
                squares[at, 0] += (change * change).mean(axis=1)
                own[at] -= RATE * change / np.sqrt(squares[at])
        y, hashes, codes = tokens.members(of_key, use)
        leaf = sizes.leaf(hashes)
        for a in range(0, len(y), batch):
            b = a + batch
            change = trees.gradient(own_inside, y[a:b], leaf[a:b], [c[a:b] for c in codes])
            squares_inside += change * change
            own_inside -= RATE * change / np.sqrt(squares_inside)
    if seen:
        change = ((own - weights) * np.float32(seen)).reshape(-1)
        parts = [x.tobytes() for x in np.array_split(change, SLICES)]
        # Weights that few tokens touched keep what those learned: each counts by its own gradients.
        trust = np.sqrt(squares_inside - 1)
        moved = [x.tobytes() for x in np.array_split((own_inside - inside).astype(np.float16), SLICES)]
        trusts = [x.tobytes() for x in np.array_split(trust, SLICES)]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(list(range(SLICES))), pa.array([seen] * SLICES), pa.array(parts, pa.binary()),
                pa.array(moved, pa.binary()), pa.array(trusts, pa.binary()),
            ],
            names=["slice", "seen", "change", "moved", "trust"],
        )


def _added(table: pa.Table) -> pa.Table:
    total, moved, trusts = 0.0, 0.0, 0.0
    for x, m, t in zip(*(table.column(name) for name in ("change", "moved", "trust")), strict=True):
        total = total + np.frombuffer(x.as_buffer(), np.float32).astype(np.float64)
        trust = np.frombuffer(t.as_buffer(), np.float32).astype(np.float64)
        moved = moved + np.frombuffer(m.as_buffer(), np.float16) * trust
        trusts = trusts + trust
    moved = moved / np.maximum(trusts, 1e-9)
    return pa.table(
        {
            "slice": table.column("slice")[:1], "grp": table.column("grp")[:1],
            "seen": pa.array([sum(table.column("seen").to_pylist())], pa.int64()),
            "change": pa.array([total.astype(np.float32).tobytes()], pa.binary()),
            "moved": pa.array([moved.astype(np.float16).tobytes()], pa.binary()),
            "trust": pa.array([trusts.astype(np.float32).tobytes()], pa.binary()),
        }
    )


def _round(
    blocks: DataFrame, weights: np.ndarray, inside: np.ndarray, trees: Trees, of_key: np.ndarray, sizes: Sizes,
    train: Callable, turn: int,
) -> tuple[np.ndarray, np.ndarray]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _gradient_steps(batches, weights, inside, trees, of_key, sizes, train, turn)

    schema = "slice long, grp long, seen long, change binary, moved binary, trust binary"
    changes = blocks.mapInArrow(run, "slice long, seen long, change binary, moved binary, trust binary")
    changes = stored(changes.withColumn("grp", F.spark_partition_id().cast("long")))
    most = changes.agg(F.max("grp")).first()[0]
    if most is None:
        return weights, inside
    while most > 0:  # sums of at most ``FAN`` rows each
        changes = changes.withColumn("grp", F.expr(f"grp div {FAN}")).groupBy("slice", "grp")
        changes = stored(changes.applyInArrow(_added, schema))
        most //= FAN
    found = {row["slice"]: row for row in changes.collect()}  # one row a slice
    change = np.concatenate([np.frombuffer(found[k]["change"], np.float32) for k in range(SLICES)])
    moved = np.concatenate([np.frombuffer(found[k]["moved"], np.float16) for k in range(SLICES)])
    return weights + change.reshape(weights.shape) / np.float32(found[0]["seen"]), inside + moved


def score_texts(docs: DataFrame, modulus: int, remainder: int) -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``, ``base_score`` and
    ``score`` of each whole text; rows whose crc32 of the id has the remainder are not learned from."""

    def train(crc: np.ndarray) -> np.ndarray:
        return crc % modulus != remainder

    blocks = pack(docs.select("doc_id", "text"))
    total = blocks.agg(F.sum("bytes")).first()[0] or 0
    count = int(max(LEAST_BUCKETS, total // BUCKET_BYTES))
    sent = blocks.mapInArrow(
        lambda batches: _counted(batches, count, train),
        "bucket long, block long, words binary, counts binary, keys binary, follows array<long>",
    )
    sent = stored(sent)
    whole = sent.filter("bucket < 0")
    follows = _by_place(whole, "follows", KEYS * CONTEXTS)
    ends = whole.agg(F.sum("block")).first()[0] or 0
    number = follows.reshape(KEYS, CONTEXTS).sum(axis=1)  # training tokens of each key
    of_key = clustered(follows, number) if number.any() else np.ones(KEYS, np.int64)
    total_words = int(number.sum())
    sizes = Sizes.of(total_words)
    merged = stored(
        sent.filter("bucket >= 0").drop("follows").groupBy("bucket").applyInArrow(
            lambda table: _merged(table, of_key, sizes),
            "bucket long, block long, totals binary, cells array<long>, number array<long>, kinds array<long>",
        )
    )
    # Groups follow the order of hashes, as buckets do, so few buckets have the same cells.
    cell_words, distinct = np.ones(CLASSES << sizes.bits), 0
    for row in merged.filter("block IS NULL").select("cells", "number", "kinds").toLocalIterator():
        np.add.at(cell_words, row["cells"], np.add(row["number"], row["kinds"]))
        distinct += sum(row["kinds"])
    cell_words = cell_words.reshape(CLASSES, -1)
    trees, inside = Trees(sizes, cell_words), np.zeros(sizes.table, np.float32)
    weights = np.zeros((2 * sizes.rows + PAIRS + 1, CLASSES), np.float32)
    start = np.bincount(of_key, number, CLASSES) + 1.0
    start[0] = ends + 1.0
    weights[-1] = np.log(start / start.sum())
    shares = blocks.coalesce(max(1, total_words // (TOKENS_A_WEIGHT * sizes.table)))
    for turn in range(ROUNDS):
        weights, inside = _round(shares, weights, inside, trees, of_key, sizes, train, turn)
    model = Model(of_key, weights, inside, cell_words, total_words + ends, distinct + (ends > 0), ends)

    counts = merged.filter("block IS NOT NULL").groupBy("block").agg(
        F.sort_array(F.collect_list(F.struct("bucket", "totals"))).alias("totals")
    )
    joined = blocks.join(counts, "block", "left")

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            tokens = Tokens(row)
            known = b"".join(t["totals"] for t in row["totals"] or ())
            _, place = np.unique(tokens.hashes, return_inverse=True)
            c = np.full(len(tokens.text), model.ends, np.int64)
            c[~tokens.end] = np.frombuffer(known, np.int64)[place]
            count_part = np.log10(c + 1.0)
            n = np.diff(tokens.bounds)
            all_words = np.log10(float(max(1, model.tokens + model.distinct + 1)))
            base = per_text_sum(count_part, tokens.bounds) - n * all_words
            classes, features = tokens.classes(model.of_key), tokens.features(model.of_key, sizes.rows)
            gained = np.empty(len(classes))
            for a in range(0, len(classes), BATCH):
                x = _logits(model.weights, features[:, a : a + BATCH])
                y = classes[a : a + BATCH]
                gained[a : a + BATCH] = x[np.arange(len(y)), y] - np.log(np.exp(x).sum(axis=1))
            y, hashes, codes = tokens.members(model.of_key, ~tokens.end)
            leaf, chance = sizes.leaf(hashes), np.empty(len(y))
            for a in range(0, len(y), BATCH):
                b = a + BATCH
                chance[a:b] = trees.log_chance(model.inside, y[a:b], leaf[a:b], [c[a:b] for c in codes])
            gained[~tokens.end] += chance
            within = np.zeros(len(classes))
            within[~tokens.end] = count_part[~tokens.end] - np.log10(model.cell_words[y, leaf])
            scores = per_text_sum(gained / np.log(10) + within, tokens.bounds)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(row["ids"], pa.int64()), pa.array(~train(tokens.crc)), pa.array(n),
                    pa.array(per_text_sum((c > 0).astype(np.int64), tokens.bounds)),
                    pa.array(np.full(len(n), model.tokens)), pa.array(base), pa.array(scores),
                ],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return joined.mapInArrow(
        score,
        "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, "
        "base_score double, score double",
    )
