"""Byte-level BPE: ranked merges folded over the byte arrays of distinct words; decoding in Spark.

``fold_words`` is the fold in Spark's higher-order functions over a literal rank map, for tables of
distinct words. Encoding whole corpora with it needs either the fold in every document or a join of
every word occurrence with the table of distinct words, and neither meets the limits (figures in the
README). ``encode`` therefore folds in the tasks: the distinct words of a slice of documents that the
task has not met before are folded side by side, in arrays of symbols, one merge a word and round.

Decoding looks the bytes of each id up in a literal table and concatenates them.

Cases: null and empty texts have no ids and decode to no bytes. Words beyond 256 bytes are folded
with a queue in n log n. Columns of the input named like new ones are replaced.
"""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablestream.llm.common import let
from tablestream.llm.textarrays import flat, slices

LONG_WORD = 256
#: Words that a task remembers before it starts anew.
REMEMBERED = 300_000
NOTHING = np.int64(1) << 62


def read_ranks(path: str) -> list[bytes]:
    """Tokens in the order of their ranks, which are 0, 1, 2 and so on."""
    with open(path, "rb") as file:
        ranked = {int(rank): base64.b64decode(token) for token, rank in map(bytes.split, file)}
    tokens = [ranked.get(k) for k in range(len(ranked))]
    if None in tokens:
        raise ValueError("ranks have gaps")
    return tokens


def _merges(tokens: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Which two symbols make which: sorted keys of pairs, and the symbol of each."""
    rank = {t: k for k, t in enumerate(tokens)}
    pairs = {}
    for merged, token in enumerate(tokens):
        for cut in range(1, len(token)):
            left, right = rank.get(token[:cut]), rank.get(token[cut:])
            if left is not None and right is not None:
                pairs[left * len(tokens) + right] = merged
    keys = np.array(sorted(pairs), np.int64)
    return keys, np.array([pairs[k] for k in keys.tolist()], np.int64)


class Folder:
    """Folds merges over words and remembers the results."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: k for k, t in enumerate(tokens)}
        self.size = len(tokens)
        keys, merged = _merges(tokens)
        # An open table of pairs: twice the room, neighbours on collision.
        self.bits = max(4, int(2 * len(keys)).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.merged = np.zeros(1 << self.bits, np.int64)
        place = self._home(keys)
        left = np.arange(len(keys))
        while len(left):
            free = self.keys[place[left]] < 0
            at, first = np.unique(place[left[free]], return_index=True)
            taken = left[free][first]
            self.keys[at], self.merged[at] = keys[taken], merged[taken]
            left = np.setdiff1d(left, taken, assume_unique=True)
            place[left] = (place[left] + 1) & ((1 << self.bits) - 1)
        self.bytes = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ids = np.empty(0, np.int64)
        self.start = np.empty(0, np.int64)
        self.count = np.empty(0, np.int64)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def pairs(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The symbol that two make, which is also the rank of the merge; ``NOTHING`` if none."""
        key = left * self.size + right
        place = self._home(key)
        out = np.full(len(key), NOTHING)
        open_ = np.arange(len(key))
        while len(open_):
            seen = self.keys[place[open_]]
            hit = seen == key[open_]
            out[open_[hit]] = self.merged[place[open_[hit]]]
            open_ = open_[~hit & (seen >= 0)]
            place[open_] = (place[open_] + 1) & ((1 << self.bits) - 1)
        return out

    def _long(self, word: bytes) -> list[int]:
        symbols = [int(self.bytes[b]) for b in word]
        ahead, behind = list(range(1, len(word) + 1)), list(range(-1, len(word) - 1))
        alive = [True] * len(word)

        def found(k: int) -> tuple[int, int, int, int] | None:
            if not (0 <= k and ahead[k] < len(word)):
                return None
            made = self.rank.get(self.tokens[symbols[k]] + self.tokens[symbols[ahead[k]]])
            return None if made is None else (made, k, symbols[k], symbols[ahead[k]])

        queue = [x for x in map(found, range(len(word))) if x]
        heapq.heapify(queue)
        while queue:
            made, k, one, two = heapq.heappop(queue)
            after = ahead[k]
            if not alive[k] or symbols[k] != one or after >= len(word) or symbols[after] != two:
                continue
            symbols[k], alive[after], ahead[k] = made, False, ahead[after]
            if ahead[k] < len(word):
                behind[ahead[k]] = k
            for x in map(found, (behind[k], k)):
                if x:
                    heapq.heappush(queue, x)
        return [s for s, here in zip(symbols, alive, strict=True) if here]

    def fold(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word: merge after merge, the lowest rank first, the leftmost of equals."""
        out: list = [None] * len(words)
        rest = []
        for k, word in enumerate(words):
            whole = self.rank.get(word)
            if whole is not None:
                out[k] = np.array([whole])
            elif len(word) > LONG_WORD:
                out[k] = np.array(self._long(word))
            else:
                rest.append(k)
        if not rest:
            return out
        active = np.array(rest)
        lengths = np.array([len(words[k]) for k in rest])
        symbols = self.bytes[np.frombuffer(b"".join(words[k] for k in rest), np.uint8)]
        while len(active):
            starts = np.concatenate([[0], np.cumsum(lengths)])
            ends = starts[1:] - 1
            rank = np.full(len(symbols), NOTHING)
            rank[:-1] = self.pairs(symbols[:-1], symbols[1:])
            rank[ends] = NOTHING
            least = np.minimum.reduceat(rank, starts[:-1])
            done = least == NOTHING
            for k in np.flatnonzero(done).tolist():
                out[active[k]] = symbols[starts[k] : starts[k + 1]]
            owner = np.repeat(np.arange(len(active)), lengths)
            spots = np.flatnonzero((rank == least[owner]) & ~done[owner])
            first = np.ones(len(spots), bool)
            first[1:] = owner[spots[1:]] != owner[spots[:-1]]
            spots = spots[first]
            symbols[spots] = rank[spots]
            stays = ~done[owner]
            stays[spots + 1] = False
            symbols = symbols[stays]
            active, lengths = active[~done], lengths[~done] - 1
        return out

    def learn(self, words: list[str]) -> None:
        if len(self.known) + len(words) > REMEMBERED:
            self.forget()
        found = self.fold([w.encode() for w in words])
        count = np.array([len(x) for x in found], np.int64)
        start = len(self.ids) + np.concatenate([[0], np.cumsum(count)[:-1]]) if len(found) else count
        self.known.update(zip(words, range(len(self.start), len(self.start) + len(words)), strict=True))
        self.ids = np.concatenate([self.ids, *found])
        self.start, self.count = np.concatenate([self.start, start]), np.concatenate([self.count, count])


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", name: str = "ids") -> DataFrame:
    """Add the ids of each whole text. The rank file is read by the driver and travels with the
    tasks; its size is fixed."""
    tokens = read_ranks(path)
    docs = docs.drop(name)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(pattern).findall
        folder = Folder(tokens)
        for part in slices(batches, text):
            raw, offsets = flat(part.column(text))
            data = raw.tobytes()
            words: list[str] = []
            bounds = [0]
            for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
                words += find(data[a:b].decode())
                bounds.append(len(words))
            fresh = set(words).difference(folder.known)
            if len(folder.known) + len(fresh) > REMEMBERED:
                folder.forget()
                fresh = set(words)
            folder.learn(sorted(fresh))
            at = np.fromiter(map(folder.known.__getitem__, words), np.int64, len(words))
            count = folder.count[at]
            total = np.concatenate([[0], np.cumsum(count)])
            source = np.repeat(folder.start[at] - total[:-1], count) + np.arange(total[-1])
            ids = pa.ListArray.from_arrays(
                pa.array(total[np.array(bounds)].astype(np.int32)), pa.array(folder.ids[source].astype(np.int32))
            )
            yield pa.RecordBatch.from_arrays([*part.columns, ids], names=[*part.schema.names, name])

    added = StructType.fromDDL(f"{name} array<int>")
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))


def decoded(ids: Column, path: str) -> Column:
    """The bytes that ids stand for, concatenated. Pieces travel as hex, whose strings Spark joins in
    one pass."""
    pieces = F.split(F.lit(",".join(t.hex() for t in read_ranks(path))), ",")
    return F.unhex(F.array_join(F.transform(ids, lambda i: F.get(pieces, i)), ""))


def fold_words(words: DataFrame, path: str, word: str = "word", name: str = "ids") -> DataFrame:
    """The fold in higher-order functions: a row for each distinct word, its bytes as hex symbols,
    merged once for each step of the fold.

    Ranks are a literal array of cells; a hash of a symbol names its cell, which is read as a small
    map, so a lookup takes the same time for any number of ranks.
    """
    tokens = read_ranks(path)
    room = max(1, len(tokens) // 2)
    cells: list[list[str]] = [[] for _ in range(room)]
    for rank, token in enumerate(tokens):
        cells[zlib.crc32(token.hex().encode()) % room].append(f"{token.hex()}:{rank}")
    table = F.split(F.lit("|".join(",".join(c) for c in cells)), r"\|")

    def rank(symbol: Column) -> Column:
        cell = F.get(table, (F.crc32(symbol.cast("binary")) % room).cast("int"))
        return F.try_element_at(F.str_to_map(cell, F.lit(","), F.lit(":")), symbol).cast("int")

    def merge(p: Column) -> Column:
        made = F.transform(
            F.sequence(F.lit(1), F.size(p) - 1),
            lambda i: F.struct(
                rank(F.concat(F.get(p, i - 1), F.get(p, i))).alias("rank"), i.alias("at")
            ),
        )
        best = F.array_min(F.filter(made, lambda x: x["rank"].isNotNull()))

        def merged(x: Column) -> Column:
            at = x["at"]
            return F.concat(
                F.slice(p, F.lit(1), at - 1),
                F.array(F.concat(F.get(p, at - 1), F.get(p, at))),
                F.slice(p, at + 2, F.greatest(F.size(p) - at - 1, F.lit(0))),
            )

        step = let(best, lambda x: F.when(x.isNull(), p).otherwise(merged(x)))
        return F.when(F.size(p) > 1, step).otherwise(p)

    hexed = F.lower(F.hex(F.col(word).cast("binary")))
    symbols = F.regexp_extract_all(hexed, F.lit(".."), F.lit(0))
    folded = F.aggregate(F.sequence(F.lit(1), F.greatest(F.size(symbols), F.lit(1))), symbols, lambda p, _: merge(p))
    whole = rank(hexed)
    ids = F.when(whole.isNotNull(), F.array(whole)).otherwise(F.transform(folded, rank))
    return words.withColumn(name, ids)
