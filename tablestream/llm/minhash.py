"""Near-duplicates of whole texts by b-bit MinHash.

Each text becomes its set of five-word shingles. Minima of 126 permutations give 42 band keys of
three, for candidates, and a signature of the lowest four bits of each minimum, packed into eight
longs. Texts with equal sets are one class, with a number of its own, and only one of its texts goes
on. Full sets are built for the classes that share a band key, from the texts that a Bloom filter of
their ids lets through; what it lets through by chance falls out by the sums of its set.

Documents that share a band key are candidates. They are never expanded into all pairs: tasks compare
the signatures of a bucket by bit counts, in slices of bounded size, and name for each document the
most similar smaller one. Those links are confirmed on the full sets and joined into components. Then
only buckets with several components are open. There, pairs of different components that are similar
by estimate are held against a bound that is exact: a bitmap of each set says how many shingles two
sets can share at most. The pairs that may reach 0.75 are confirmed, whatever their number.

A pair at the limit of 0.75 shares no band key with probability (1 - 0.75**3)**42 < 2e-10, and its
estimate is below the cut of 0.55 with probability below 1e-6; both fall fast above the limit.

Cases: null, empty and blank texts have no shingles and are linked with nothing; with fewer than
five words the whole sequence is the one shingle. Rows without an id take part in nothing and are
kept. Every row is a document: rows that share an id but not the text have links of their own, and
the least id a row can reach may be its own id by another row. Repeated rows are copies of each other.
Other columns of the input play no part.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import plain_plans, stored
from tablestream.llm.graph import components
from tablestream.llm.idfilter import IdFilter
from tablestream.llm.textarrays import LOWER, NOT_BLANK, Hashes, Words, flat, mixed, per_text_sum, slices

SHINGLE = 5
BANDS, ROWS = 42, 3
MINIMA = BANDS * ROWS
BITS = 4
LONGS = MINIMA * BITS // 64 + 1
PERCENT = 75
#: Candidates with a lower estimated similarity are dropped: five standard deviations below 0.75.
ESTIMATE_CUT = 0.55
#: Documents of a bucket whose signatures are compared at once, and rows that share a task.
SLICE, TASK_ROWS = 1024, 5_000
#: Text that a task works on at once.
TASK_BYTES = 1 << 20
#: Bits of the map of a set. Larger sets have fuller maps and looser bounds, never wrong ones.
MAP_BITS = 1 << 13

_FACTORS = np.random.default_rng(7).integers(0, 2**63, MINIMA, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_NIBBLE_ENDS = np.uint64(0x1111111111111111)


def shingle_sets(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, ascending, and the bounds of each text's."""
    raw, offsets = flat(column)
    raw = LOWER[raw]
    words = Words(raw, offsets, NOT_BLANK)
    shingles, bounds = words.shingles(Hashes(raw)(words.start, words.end), SHINGLE)
    owner = np.repeat(np.arange(words.texts), np.diff(bounds))
    order = np.lexsort((shingles, owner))
    shingles, owner = shingles[order], owner[order]
    new = np.ones(len(shingles), bool)
    new[1:] = (shingles[1:] != shingles[:-1]) | (owner[1:] != owner[:-1])
    return shingles[new], np.searchsorted(owner[new], np.arange(words.texts + 1))


def _sums(sets: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Two sums over each set that do not depend on the order of its members."""
    mask = np.uint64(0xA5A5A5A5A5A5A5A5)
    return np.stack([per_text_sum(mixed(sets), bounds), per_text_sum(mixed(sets ^ mask), bounds)])


def _signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in slices(batches, "text", TASK_BYTES):
        sets, bounds = shingle_sets(part.column("text"))
        sizes = np.diff(bounds)
        full = np.flatnonzero(sizes)
        starts = bounds[:-1][full]
        minima = np.zeros((part.num_rows, MINIMA), np.uint64)
        for k, factor in enumerate(_FACTORS if len(full) else ()):
            minima[full, k] = np.minimum.reduceat(sets * factor, starts)
        keys = minima.reshape(-1, BANDS, ROWS)
        band = np.arange(1, BANDS + 1, dtype=np.uint64)
        code = np.zeros(keys.shape[:2], np.uint64)
        for k in range(ROWS):
            code = mixed((code ^ band) * np.uint64(0x9E3779B97F4A7C15) + keys[:, :, k])
        low = mixed(minima) & np.uint64((1 << BITS) - 1)
        per_long = 64 // BITS
        low = np.pad(low, ((0, 0), (0, LONGS * per_long - MINIMA))).reshape(-1, LONGS, per_long)
        packed = (low << (np.arange(per_long, dtype=np.uint64) * np.uint64(BITS))).sum(axis=2, dtype=np.uint64)
        sums = _sums(sets, bounds)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("doc_id"),
                part.column("carried"),
                pa.array(sizes.astype(np.int64)),
                pa.array(sums[0].view(np.int64)),
                pa.array(sums[1].view(np.int64)),
                pa.array(list(code.view(np.int64)), pa.list_(pa.int64())),
                pa.array(list(packed.view(np.int64)), pa.list_(pa.int64())),
            ],
            names=["doc_id", "carried", "n_shingles", "s0", "s1", "bands", "packed"],
        )


def _sets(wanted: IdFilter):
    """Full sets of the texts whose ids the filter lets through."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices([batch.filter(wanted.lets(batch.column("doc_id")))], "text", TASK_BYTES):
                sets, bounds = shingle_sets(part.column("text"))
                sums = _sums(sets, bounds).view(np.int64)
                found, maps = [], []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    found.append(sets[a:b].tobytes())
                    bits = np.zeros(MAP_BITS, bool)
                    bits[(sets[a:b] >> np.uint64(65 - MAP_BITS.bit_length())).astype(np.int64)] = True
                    maps.append(np.packbits(bits).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(np.diff(bounds)), *map(pa.array, sums),
                     pa.array(found, pa.binary()), pa.array(maps, pa.binary())],
                    names=["rep", "n_shingles", "s0", "s1", "members", "map"],
                )

    return build


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        links = []
        for x, y in zip(batch.column("x"), batch.column("y"), strict=True):
            one = np.frombuffer(x.as_buffer(), np.uint64)
            two = np.frombuffer(y.as_buffer(), np.uint64)
            common = int((np.searchsorted(two, one, "right") - np.searchsorted(two, one, "left")).sum())
            links.append(100 * common >= PERCENT * (len(one) + len(two) - common))
        yield pa.RecordBatch.from_arrays(
            [batch.column("a"), batch.column("b"), pa.array(links, pa.bool_())], names=["a", "b", "linked"]
        )


def estimated(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Similarity of each two packed signatures from the bits in which they differ, corrected for the
    share of minima whose low bits agree by chance."""
    bits = one[:, None, :] ^ two[None, :, :]
    for step in (1, 2):  # any set bit of a field ends up in its lowest
        bits |= bits >> np.uint64(step)
    differ = np.bitwise_count(bits & _NIBBLE_ENDS).sum(axis=2, dtype=np.int64)
    agree, chance = 1 - differ / MINIMA, 2.0**-BITS
    return (agree - chance) / (1 - chance)


def _possible(ids: np.ndarray, others: np.ndarray, maps: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Whether pairs can be linked at all: sets share no more shingles than their maps share bits,
    and as many more as the smaller number of shingles that lost their bit to another."""
    ones = np.bitwise_count(maps).sum(axis=1, dtype=np.int64)
    out = np.zeros(len(ids), bool)
    for low in range(0, len(ids), 8192):
        x, y = ids[low : low + 8192], others[low : low + 8192]
        common = np.bitwise_count(maps[x] & maps[y]).sum(axis=1, dtype=np.int64)
        common += np.minimum(sizes[x] - ones[x], sizes[y] - ones[y])
        out[low : low + 8192] = 100 * common >= PERCENT * (sizes[x] + sizes[y] - common)
    return out


def _partners(rows: DataFrame, tasks: int, first: bool) -> DataFrame:
    """Pairs ``a`` < ``b`` in different components, similar by estimate, with ``est``, of each bucket
    slice: with ``first``, the most similar smaller one of each document, or else all that the maps
    of their sets allow.

    ``rows``: key, id, i, j, c, packed, map, size; rows with equal key, i and j are compared.
    """

    def compared(table: pa.Table) -> pa.Table:
        columns = [table.column(n).to_numpy() for n in ("key", "i", "j", "id", "c", "size")]
        signed = table.column("packed").combine_chunks()
        signed = signed.flatten().to_numpy(zero_copy_only=False).view(np.uint64).reshape(-1, LONGS)
        order = np.lexsort(columns[2::-1])
        key, i, j, ids, comps, sizes = (x[order] for x in columns)
        signed = signed[order]
        if not first:
            maps = b"".join(table.column("map").to_pylist())
            maps = np.frombuffer(maps, np.uint64).reshape(-1, MAP_BITS // 64)[order]
        new = np.ones(len(key), bool)
        new[1:] = (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.append(np.flatnonzero(new), len(key))
        out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True):
            if b - a < 2:
                continue
            for low in range(a, b, 256):
                mine = slice(low, min(low + 256, b))
                est = estimated(signed[mine], signed[a:b])
                smaller = ids[None, a:b] < ids[mine, None]
                est[~smaller | (comps[mine, None] == comps[None, a:b])] = -1.0
                if first:
                    place = est.argmax(axis=1)
                    line = np.flatnonzero(est[np.arange(len(est)), place] >= ESTIMATE_CUT)
                    place = place[line]
                else:
                    line, place = np.nonzero(est >= ESTIMATE_CUT)
                    may = _possible(low + line, a + place, maps, sizes)
                    line, place = line[may], place[may]
                out.append((ids[a + place], ids[low + line], est[line, place]))
        return pa.table([np.concatenate(x) for x in zip(*out, strict=True)], names=["a", "b", "est"])

    task = F.pmod(F.xxhash64("key", "i", "j"), F.lit(tasks)).alias("task")
    return rows.groupBy(task).applyInArrow(compared, "a long, b long, est double")


def _merged(labels: DataFrame, tried: DataFrame) -> DataFrame:
    """Labels (id, c) after the confirmed links among ``tried``."""
    links = tried.filter("linked")
    for end in ("a", "b"):
        links = links.join(labels.select(F.col("id").alias(end), F.col("c").alias(f"c{end}")), end)
    found = components(links.select(F.col("ca").alias("a"), F.col("cb").alias("b")))
    found = found.select(F.col("id").alias("c"), F.col("component").alias("to"))
    return stored(labels.join(found, "c", "left").select("id", F.coalesce("to", "c").alias("c")))


def near_duplicates(docs: DataFrame, carry: str | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (least document reachable over links of at
    least 75 % common shingles) and ``kept`` (is that document) for each row of ``docs``.

    With ``carry``, the name of a long column of ``docs`` that tells rows of one id apart, also that
    column and ``group``, the number of the row's component (null without shingles)."""
    with plain_plans(docs.sparkSession):
        return _near_duplicates(docs, [carry] if carry else [])


def _near_duplicates(docs: DataFrame, carry: list[str]) -> DataFrame:
    held = docs.select("doc_id", "text", (F.col(carry[0]) if carry else F.lit(0)).cast("long").alias("carried"))
    docs = docs.select("doc_id", "text")
    signed = stored(
        held.mapInArrow(
            _signatures,
            "doc_id long, carried long, n_shingles long, s0 long, s1 long, bands array<long>, packed array<long>",
        )
    )
    signed = signed.withColumnRenamed("carried", carry[0]) if carry else signed.drop("carried")
    able = signed.filter("n_shingles > 0 AND doc_id IS NOT NULL")
    key = ["s0", "s1", "n_shingles"]
    # Numbered once, in a table.
    classes = able.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    classes = stored(classes.withColumn("id", F.monotonically_increasing_id()))
    member = able.select("doc_id", *carry, *key).join(classes, key)
    member = stored(member.select("doc_id", *carry, "n_shingles", "id", "rep"))
    reps = able.withColumnRenamed("doc_id", "rep").join(classes, ["rep", *key]).dropDuplicates(["id"])
    reps = stored(reps.select("id", "bands", "packed"))

    bands = reps.select("id", F.explode("bands").alias("key"))
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    shared = stored(shared.filter("n > 1"))
    members = stored(bands.join(shared, "key"))
    labels = stored(members.select("id").distinct().withColumn("c", F.col("id")))
    signatures = stored(reps.select("id", "packed").join(labels, "id", "left_semi"))
    chosen = stored(classes.join(signatures.select("id"), "id", "left_semi"))
    wanted = IdFilter.of(chosen.select(F.col("rep").alias("id")))
    built = docs.mapInArrow(_sets(wanted), "rep long, n_shingles long, s0 long, s1 long, members binary, map binary")
    sets = built.join(chosen, ["rep", *key]).dropDuplicates(["id"]).select("id", "members", "map")
    sets = stored(sets)
    tasks = max(16, members.count() // TASK_ROWS)

    def side(name: str, value: str) -> DataFrame:
        return sets.select(F.col("id").alias(name), F.col("members").alias(value))

    def confirmed(pairs: DataFrame) -> DataFrame:
        full = pairs.select("a", "b").join(side("a", "x"), "a").join(side("b", "y"), "b")
        return stored(full.mapInArrow(_confirmed, "a long, b long, linked boolean"))

    # Large buckets are cut: first each slice is compared with itself, later with every other.
    cuts = F.ceil(F.col("n") / SLICE).cast("int")
    own = F.pmod(F.xxhash64("id"), cuts).cast("int")
    none = F.lit(None).cast("binary").alias("map"), F.lit(0).cast("long").alias("size")
    alone = members.join(signatures, "id").select(
        "key", "id", own.alias("i"), own.alias("j"), F.col("id").alias("c"), "packed", *none
    )
    near = _partners(alone, tasks, True)
    best = near.groupBy("b").agg(F.max(F.struct("est", (-F.col("a")).alias("minus")))["minus"].alias("minus"))
    tried = confirmed(best.select((-F.col("minus")).alias("a"), "b"))
    labels = _merged(labels, tried)

    placed = members.join(labels, "id")
    mixed_keys = placed.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi"))
    mixed_keys = stored(mixed_keys.filter("lo != hi").select("key"))
    maps = sets.select("id", "map", (F.octet_length("members") / 8).cast("long").alias("size"))
    still = placed.join(mixed_keys, "key").join(signatures, "id").join(maps, "id")
    other = F.explode(F.sequence(F.lit(0), cuts - 1))
    still = still.select("key", "id", "c", "packed", "map", "size", own.alias("s"), other.alias("t")).select(
        "key", "id", F.least("s", "t").alias("i"), F.greatest("s", "t").alias("j"), "c", "packed", "map", "size"
    )
    rest = _partners(still, tasks, False).select("a", "b").distinct()
    labels = _merged(labels, confirmed(rest.join(tried.select("a", "b"), ["a", "b"], "left_anti")))

    found = member.select("id", "rep").distinct().join(labels, "id", "left")
    found = found.select("id", "rep", F.coalesce("c", "id").alias("group"))
    least = found.groupBy("group").agg(F.min("rep").alias("component_id"))
    found = found.join(least, "group").select("id", "group", "component_id")
    linked = member.join(found, "id").select("doc_id", "n_shingles", "component_id", *carry, "group")
    rest = signed.filter("n_shingles = 0 OR doc_id IS NULL")
    rest = rest.select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id"), *carry, F.lit(None).cast("long").alias("group")
    )
    both = linked.unionByName(rest)
    both = both.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    return both.select("doc_id", "n_shingles", "component_id", "kept", *([*carry, "group"] if carry else []))
