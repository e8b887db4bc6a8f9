"""Phrase collocations from sorted streams of counts.

All counts come from streams in order; no task holds a table of phrases to look counts up in.

1. Texts are split into pieces and words, and packed into blocks of word numbers. The words of all
   blocks are sorted; one pass over that stream gives their counts, and those that reach the least
   are numbered in the order of their language and bytes, so that the numbers of a phrase, as bytes,
   sort like the phrase and hold its language. Rarer words end a phrase, as none with them can reach
   the least count.
2. Each place gives the window of the five words from it, shorter at the end of a piece. A block
   sorts its windows, sums equal ones and cuts them at the bounds of ranges into compressed pieces.
   The ranges are cut over all five words, from evenly spread samples, so no word or pair has to fit
   one; a block brings a window once, however often it has it. The pieces of a range are merged: in
   order every phrase is a run of windows that begin with it, and one pass gives the counts of all
   lengths at once. Runs that may cross the end of a range are added up afterwards.
3. The counts that reach the least are kept as two streams. In prefix order a phrase comes after its
   own first parts and directly before its continuations, so one pass gives the counts of the left
   parts of all cuts, and whether the next word is always the same. In suffix order (words reversed)
   the same pass gives the right parts and whether the word before is always the same. What a
   partition needs from the ones before it are the at most four first parts of its first phrase.
4. The two streams are merged by phrase, and the exact score of each cut follows.

A phrase inside a longer one with the same count is inside one that is longer by one word with that
count, as counts fall with length; so continuations by one word decide.

Cases: null and empty texts have no words; a null language is ``und``; rows that are repeated count
each time; a null id doesn't matter. An empty table has no phrases.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.llm.blocks import rows
from tablestream.llm.common import numbered, stored
from tablestream.llm.textarrays import LOWER, Hashes, Words, flat, slices
from tablestream.session import cut_lineage

LONGEST = 5
LEAST = 100
#: Bytes of text in a block, and windows of a range, about. Bounds of ranges are known to all tasks:
#: 15 bytes for each RANGE_ROWS windows.
BLOCK_BYTES, RANGE_ROWS = 4 << 20, 1_500_000
HASHED_WORDS = 50_000
#: One window of so many is a sample for the bounds.
SAMPLE_EVERY = 10_000

PIECE_END = np.zeros(256, bool)
PIECE_END[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
IN_WORD = ~PIECE_END
IN_WORD[[0x20, 0x09]] = False

BLOCK = "lang string, words array<string>, counts array<long>, stream binary, places long"


def _word_codes(raw: np.ndarray, words: Words) -> np.ndarray:
    """A hash of each word, computed for some words at a time, as it takes several numbers a byte."""
    out = np.empty(len(words), np.uint64)
    for low in range(0, len(words), HASHED_WORDS):
        some = slice(low, low + HASHED_WORDS)
        start, end = words.start[some], words.end[some]
        base = int(start[0])
        out[some] = Hashes(raw[base : int(end[-1])])(start - base, end - base)
    return out


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The words of each slice and language: the distinct ones in order, with their counts, and the
    text as their numbers from 1, with 0 between pieces."""
    for part in slices(batches, "text", BLOCK_BYTES):
        langs = np.array(part.column("lang").to_pylist(), dtype=object)
        raw, offsets = flat(part.column("text"))
        raw = LOWER[raw]
        words = Words(raw, offsets, IN_WORD)
        if not len(words):
            continue
        hashes = _word_codes(raw, words)
        ends = np.cumsum(PIECE_END[raw], dtype=np.int32)[words.start]
        data = raw.tobytes()
        names, which = np.unique(langs.astype(str), return_inverse=True)
        for k, lang in enumerate(names.tolist()):
            of = np.flatnonzero(which[words.text] == k)
            if not len(of):
                continue
            codes, first, number = np.unique(hashes[of], return_index=True, return_inverse=True)
            starts, stops = words.start[of[first]].tolist(), words.end[of[first]].tolist()
            texts = [data[a:b] for a, b in zip(starts, stops, strict=True)]
            order = sorted(range(len(texts)), key=texts.__getitem__)
            place = np.empty(len(order), np.uint32)
            place[order] = np.arange(1, len(order) + 1)
            counts = np.bincount(number, minlength=len(codes))[order]
            new = np.zeros(len(of), np.int64)
            new[1:] = (ends[of][1:] != ends[of][:-1]) | (words.text[of][1:] != words.text[of][:-1])
            stream = np.zeros(len(of) + int(new.sum()), np.uint32)
            stream[np.arange(len(of)) + np.cumsum(new)] = place[number]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang]),
                    pa.array([[texts[x].decode() for x in order]], pa.list_(pa.string())),
                    pa.array([counts.tolist()], pa.list_(pa.int64())),
                    pa.array([_squeezed(stream, 4)], pa.binary()),
                    pa.array([len(of)], pa.int64()),
                ],
                names=["lang", "words", "counts", "stream", "places"],
            )


def _squeezed(numbers: np.ndarray, width: int) -> bytes:
    """Numbers of ``width`` bytes, compressed byte by byte, so that the high bytes lie together."""
    planes = numbers.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width]
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes.T).tobytes())


def _numbers(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8).reshape(width, -1)
    wide = np.zeros((planes.shape[1], 8), np.uint8)
    wide[:, :width] = planes.T
    return wide.view("<u8").ravel()


def _keys(columns: np.ndarray, width: int) -> pa.Array:
    """Rows of word numbers as bytes that sort like them."""
    n = columns.shape[1]
    wide = np.ascontiguousarray(columns.T).astype(">u8").view(np.uint8).reshape(n, LONGEST, 8)
    data = np.ascontiguousarray(wide[:, :, 8 - width :]).tobytes()
    at = np.arange(n + 1, dtype=np.int32) * np.int32(LONGEST * width)
    return pa.BinaryArray.from_buffers(pa.binary(), n, [None, pa.py_buffer(at), pa.py_buffer(data)])


def _columns(keys: pa.Array, width: int) -> np.ndarray:
    """Word numbers by place (LONGEST, rows) of keys."""
    raw, _ = flat(keys)
    wide = np.zeros((len(keys), LONGEST, 8), np.uint8)
    wide[:, :, 8 - width :] = raw.reshape(len(keys), LONGEST, width)
    return np.ascontiguousarray(wide.view(">u8").reshape(len(keys), LONGEST).T).astype(np.int64)


def _recoded(width: int):
    """The text of a block in the numbers of all words instead of its own, 0 for rare words."""

    def recode(key, blocks: pa.Table, ids: pa.Table) -> pa.Table:
        out = []
        for data, distinct in zip(blocks.column("stream").to_pylist(), blocks.column("distinct").to_pylist(), strict=True):
            number = np.zeros(distinct + 1, np.uint64)
            number[ids.column("pos").to_numpy()] = ids.column("id").to_numpy()
            out.append(_squeezed(number[_numbers(data, 4)], width))
        return pa.table([pa.array(out, pa.binary())], names=["stream"])

    return recode


def _sort_keys(columns: np.ndarray, bits: int) -> list[np.ndarray]:
    """As few 64-bit keys as the bits of the words allow that sort like the columns."""
    keys, room = [], 0
    for column in columns:
        if room < bits:
            keys.append(np.zeros(columns.shape[1], np.uint64))
            room = 64
        keys[-1] = (keys[-1] << np.uint64(bits)) | column.astype(np.uint64)
        room -= bits
    return keys


def _summed(columns: np.ndarray, n: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Windows in order, equal ones once with the sum of their counts."""
    keys = _sort_keys(columns, bits)
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        key = key[order]
        new[1:] |= key[1:] != key[:-1]
    first = np.flatnonzero(new)
    return columns[:, order[first]], np.add.reduceat(n[order], first) if len(first) else n


def _cut(words: np.ndarray) -> np.ndarray:
    """The windows of at least two words (LONGEST, places) of a stream of word numbers."""
    words = np.append(words, np.zeros(LONGEST, np.uint64))
    at = np.flatnonzero((words[:-LONGEST] > 0) & (words[1 : 1 - LONGEST] > 0))
    window = np.stack([words[at + k] for k in range(LONGEST)])
    for k in range(2, LONGEST):
        window[k][window[k - 1] == 0] = 0
    return window


def _samples(width: int):
    """Every so many windows of each block, from a place that the block's size decides."""

    def some(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            window = _cut(_numbers(row["stream"], width))
            yield pa.RecordBatch.from_arrays(
                [_keys(window[:, window.shape[1] % SAMPLE_EVERY :: SAMPLE_EVERY], width)], names=["key"]
            )

    return some


def _pieces(width: int, bits: int, bounds: np.ndarray):
    """The windows of each block, sorted, summed and cut into compressed pieces by range."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            window = _cut(_numbers(row["stream"], width))
            if not window.shape[1]:
                continue
            window, n = _summed(window, np.ones(window.shape[1], np.int64), bits)
            ends = [0, *_places(window, bounds, bits).tolist(), window.shape[1]]
            ranges, data = [], []
            for k, (a, b) in enumerate(zip(ends, ends[1:], strict=False)):
                if a < b:
                    ranges.append(k)
                    # Sorted columns as steps, which are small.
                    part = window[:, a:b].copy()
                    part[:2, 1:] -= window[:2, a : b - 1]
                    data.append([_squeezed(part.ravel(), width), _squeezed(n[a:b], 4)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ranges, pa.int64()), *(pa.array(x, pa.binary()) for x in zip(*data, strict=True))],
                names=["range", "words", "n"],
            )

    return cut


def _places(window: np.ndarray, bounds: np.ndarray, bits: int) -> np.ndarray:
    """The number of sorted windows before each bound."""
    n = window.shape[1]
    both = _sort_keys(np.concatenate([bounds, window], axis=1), bits)
    # Bounds come first, so that they stay before equal windows.
    order = np.lexsort(both[::-1])
    return np.flatnonzero(order < bounds.shape[1]) - np.arange(bounds.shape[1]) if n else np.zeros(bounds.shape[1], int)


def _run_counts(width: int, bits: int, least: int):
    """Counts of all phrases of two words and more in a range of windows: those that reach
    ``least``, and the first and the last of each length, which other ranges may hold too."""

    def count(table: pa.Table) -> pa.Table:
        parts, counts = [], []
        mask = np.uint64((1 << (8 * width)) - 1)
        for words, n in zip(table.column("words").to_pylist(), table.column("n").to_pylist(), strict=True):
            part = _numbers(words, width).reshape(LONGEST, -1).copy()
            part[:2] = np.cumsum(part[:2], axis=1, dtype=np.uint64) & mask
            parts.append(part)
            counts.append(_numbers(n, 4).astype(np.int64))
        columns, n = _summed(np.concatenate(parts, axis=1), np.concatenate(counts), bits)
        found, sums = [], []
        fresh = np.zeros(len(n), bool)
        fresh[0] = True
        for k in range(1, LONGEST + 1):
            fresh[1:] |= columns[k - 1, 1:] != columns[k - 1, :-1]
            if k == 1:
                continue
            at = np.flatnonzero(fresh)
            total = np.add.reduceat(n, at)
            keep = total >= least
            keep[[0, -1]] = True
            keep &= columns[k - 1, at] > 0  # runs of shorter windows are none
            phrases = columns[:, at[keep]]
            phrases[k:] = 0
            found.append(phrases)
            sums.append(total[keep])
        return pa.table(
            [_keys(np.concatenate(found, axis=1), width), pa.array(np.concatenate(sums), pa.int64())], names=["key", "f"]
        )

    return count


def _frequent(listed: DataFrame, least: int) -> tuple[DataFrame, int]:
    """Rows (block, pos, lang, word, counts) of words with ``least`` occurrences in all, with their
    number ``id`` from 1 in the order of language and word, and how many such words there are."""
    spread = listed.repartitionByRange("lang", "word")
    # The ranges keep each word together, in at most one row a block.
    total = F.sum("counts").over(Window.partitionBy("lang", "word"))
    every = spread.withColumn("f", total)
    every = every.sortWithinPartitions("lang", "word", "block").withColumn("place", F.spark_partition_id())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, at = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            lang, word = batch.column("lang"), batch.column("word")
            new = np.ones(batch.num_rows, bool)
            if batch.num_rows > 1:
                same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(word[1:], word[:-1]))
                new[1:] = ~same.to_numpy(zero_copy_only=False)
            new[0] = last != (lang[0].as_py(), word[0].as_py())
            last = (lang[-1].as_py(), word[-1].as_py())
            often = batch.column("f").to_numpy() >= least
            new &= often
            local = at + np.cumsum(new)
            at = int(local[-1])
            local[~often] = 0
            # The name goes with the first row of a word.
            names = [pa.array(np.where(new, column.to_numpy(zero_copy_only=False), None), pa.string()) for column in (lang, word)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("block"), batch.column("pos"), *names, batch.column("f"), batch.column("place"), pa.array(local)],
                names=["block", "pos", "lang", "word", "f", "place", "local"],
            )

    every = every.select("block", "pos", "lang", "word", "f", "place")
    numbers = every.mapInArrow(number, "block long, pos int, lang string, word string, f long, place int, local long")
    kept = stored(numbers).filter("local > 0")
    sizes = kept.groupBy("place").agg(F.max("local").alias("size")).orderBy("place").collect()  # one row a partition
    before = dict(zip((r["place"] for r in sizes), np.cumsum([0] + [r["size"] for r in sizes]).tolist(), strict=False))
    if not before:
        return kept.withColumn("id", F.col("local")), 0
    carried = F.create_map(*(F.lit(x) for pair in before.items() for x in pair))
    return kept.withColumn("id", F.col("local") + F.element_at(carried, F.col("place"))), sum(r["size"] for r in sizes)


def _first_parts(key: Column, width: int) -> Column:
    """All proper first parts of a key, each filled up with zeros."""
    zeros = bytes(LONGEST * width)
    parts = [
        F.concat(F.substring(key, 1, j * width), F.lit(zeros[j * width :])) for j in range(1, LONGEST)
    ]
    return F.array(*parts)


def _in_order(counts: DataFrame, width: int) -> DataFrame:
    """A stream of counts (key, f) in the order of the keys: with ``parts``, the counts of the first
    1 to 4 words of each phrase of more words, and ``goes_on``, whether the phrase is always followed
    by the same word."""
    placed = counts.repartitionByRange("key").sortWithinPartitions("key")
    placed = cut_lineage(placed.withColumn("place", F.spark_partition_id()))
    heads = placed.groupBy("place").agg(F.min(F.struct("key", "f")).alias("head"))
    heads = cut_lineage(heads.select("place", "head.key", "head.f"))
    # One row a partition, and at most four first parts of each.
    follows = {r["place"]: (bytes(r["key"]), r["f"]) for r in heads.collect()}
    parts = heads.select("place", F.explode(_first_parts(F.col("key"), width)).alias("key")).distinct()
    carried: dict[int, dict[bytes, int]] = {}
    for r in parts.join(placed.select("key", "f"), "key").collect():
        carried.setdefault(r["place"], {})[bytes(r["key"])] = r["f"]
    places = sorted(follows)
    later = {a: follows[b] for a, b in zip(places, places[1:], strict=False)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Columns and counts of the rows before, of each length the last one.
        last: list[int] | None = None
        held: pa.RecordBatch | None = None

        def out(batch: pa.RecordBatch, after: tuple[bytes, int] | None) -> pa.RecordBatch:
            nonlocal last
            keys, f = batch.column("key"), batch.column("f").to_numpy()
            columns = _columns(keys, width)
            length = (columns > 0).sum(axis=0)
            if last is None:
                known = carried.get(batch.column("place")[0].as_py(), {})
                head = keys[0].as_py()
                last = [known.get(head[: j * width] + bytes((LONGEST - j) * width), 0) for j in range(1, LONGEST)]
            parts = np.zeros((LONGEST - 1, len(f)), np.int64)
            for j in range(1, LONGEST):
                at = np.maximum.accumulate(np.where(length == j, np.arange(len(f)), -1))
                value = np.where(at >= 0, f[at], last[j - 1])
                last[j - 1] = int(value[-1])
                parts[j - 1] = np.where(length > j, value, 0)
            # The next row, if it is this one and a word more with the same count.
            if after is None:
                following, next_f = np.full((LONGEST, 1), -1), -1
            else:
                following, next_f = _columns(pa.array([after[0]], pa.binary()), width), after[1]
            following = np.concatenate([columns[:, 1:], following], axis=1)
            next_f = np.append(f[1:], next_f)
            child = ((columns == following) | (np.arange(LONGEST)[:, None] >= length)).all(axis=0)
            goes_on = child & (next_f == f) & ((following > 0).sum(axis=0) == length + 1)
            lists = pa.FixedSizeListArray.from_arrays(pa.array(parts.T.ravel()), LONGEST - 1)
            return pa.RecordBatch.from_arrays(
                [keys, pa.array(f), lists.cast(pa.list_(pa.int64())), pa.array(goes_on)],
                names=["key", "f", "parts", "goes_on"],
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            if held is not None:
                yield out(held, (batch.column("key")[0].as_py(), batch.column("f")[0].as_py()))
            held = batch
        if held is not None:
            yield out(held, later.get(held.column("place")[0].as_py()))

    return placed.mapInArrow(run, "key binary, f long, parts array<long>, goes_on boolean")


def _reversed(key: Column, width: int) -> Column:
    """The words of a phrase in the opposite order."""
    zero, pieces = bytes(width), [F.substring(key, 1 + j * width, width) for j in range(LONGEST)]
    words = [F.when(p == F.lit(zero), F.lit(b"")).otherwise(p) for p in reversed(pieces)]
    joined = F.concat(*words)
    return F.rpad(joined, F.lit(LONGEST * width), F.lit(b"\0"))


def collocations(docs: DataFrame, text: str = "text", lang: str = "lang", least: int = LEAST) -> DataFrame:
    """``lang``, ``phrase``, ``a``, ``l``, ``r``, ``n`` and ``score`` of all phrases of 2 to 5 words
    that occur ``least`` times or more in a language and not only as part of a longer one."""
    docs = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    blocks = stored(docs.mapInArrow(_blocks, BLOCK).withColumn("block", F.monotonically_increasing_id()))
    totals = blocks.groupBy("lang").agg(F.sum("places").alias("n"))
    listed = blocks.select("block", "lang", F.posexplode(F.arrays_zip("words", "counts")).alias("pos", "w"))
    listed = listed.select("block", "lang", (F.col("pos") + 1).alias("pos"), F.col("w.words").alias("word"), "w.counts")
    frequent, n_words = _frequent(listed, least)
    words = frequent.filter("word IS NOT NULL").select("id", "lang", "word", "f")
    bits = n_words.bit_length()
    width = max(1, (bits + 7) // 8)

    ids = frequent.select(F.col("block").alias("of"), "pos", "id")
    streams = blocks.select("block", "stream", F.size("words").alias("distinct"))
    coded = streams.groupBy("block").cogroup(ids.groupBy("of"))
    coded = stored(coded.applyInArrow(_recoded(width), "stream binary"))
    sample, _ = numbered(coded.mapInArrow(_samples(width), "key binary"), [F.col("key")], "at")
    every = max(1, RANGE_ROWS // SAMPLE_EVERY)
    # One bound for each RANGE_ROWS windows.
    bounds = [bytes(r["key"]) for r in sample.filter((F.col("at") % every == 0) & (F.col("at") > 0)).select("key").collect()]
    bounds = _columns(pa.array(sorted(set(bounds)), pa.binary()), width).astype(np.uint64)
    pieces = coded.mapInArrow(_pieces(width, bits, bounds), "range long, words binary, n binary")
    counts = pieces.groupBy("range").applyInArrow(_run_counts(width, bits, least), "key binary, f long")
    counts = counts.groupBy("key").agg(F.sum("f").alias("f")).filter(F.col("f") >= least)
    alone = words.select(_word_key(F.col("id"), width).alias("key"), "f")
    counts = stored(counts.unionByName(alone))

    before = _in_order(counts, width)
    turned = _in_order(counts.select(_reversed(F.col("key"), width).alias("key"), "f"), width)
    after = turned.select(
        _reversed(F.col("key"), width).alias("key"), F.col("parts").alias("ends"), F.col("goes_on").alias("comes_on")
    )
    merged = before.join(after.hint("merge"), "key").filter("NOT goes_on AND NOT comes_on AND parts[0] > 0")

    numbers = F.array(*(F.conv(F.hex(F.substring("key", 1 + j * width, width)), 16, 10).cast("long") for j in range(LONGEST)))
    merged = stored(merged.withColumn("ids", F.filter(numbers, lambda x: x > 0)))
    named = (
        merged.select("key", F.posexplode("ids").alias("pos", "id"))
        .join(words.select("id", "lang", "word"), "id")
        .groupBy("key")
        .agg(F.array_sort(F.collect_list(F.struct("pos", "word"))).alias("w"), F.first("lang").alias("lang"))
        .select("key", "lang", F.array_join("w.word", " ").alias("phrase"))
    )
    found = merged.select("key", F.size("ids").alias("k"), "f", "parts", "ends").join(named, "key").join(totals, "lang")

    def cut(j: Column) -> Column:
        left, right = F.element_at("parts", j), F.element_at("ends", F.col("k") - j)
        wide = "decimal(38,0)"
        top = F.lit(1000).cast(wide) * F.col("f").cast("decimal(19,0)")
        top = top.cast(wide) * F.col("n").cast("decimal(19,0)")
        score = _quotient(top.cast(wide), (left.cast("decimal(19,0)") * right.cast("decimal(19,0)")).cast(wide))
        return F.struct(score.alias("score"), j.alias("j"), left.alias("l"), right.alias("r"))

    best = F.array_min(F.transform(F.sequence(F.lit(1), F.col("k") - 1), cut))
    return found.withColumn("best", best).select(
        "lang", "phrase", F.col("f").alias("a"), "best.l", "best.r", "n", "best.score"
    )


def _quotient(top: Column, bottom: Column) -> Column:
    return F.call_function("div", top, bottom).cast("long")


def _word_key(number: Column, width: int) -> Column:
    digits = F.lpad(F.hex(number), 2 * width, "0")
    return F.unhex(F.rpad(digits, 2 * LONGEST * width, "0"))


def top(phrases: DataFrame, limit: int) -> DataFrame:
    """The first ``limit`` of each language by score, count and phrase, with their ``rank``."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= limit)
