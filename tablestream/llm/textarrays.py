"""Whole texts of an Arrow batch as flat numpy arrays: bytes, words, hashes.

Used inside tasks. Batches are cut into slices of a few MB of text so that the arrays built for
one slice stay small, however many rows Spark puts into a batch; one text is never cut.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20

#: Byte classes. Bytes from 0x80 on belong to code points beyond ASCII.
NOT_BLANK = np.ones(256, bool)
NOT_BLANK[[0x20, *range(0x09, 0x0E)]] = False
ALPHANUMERIC = np.zeros(256, bool)
ALPHANUMERIC[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE_CODES = np.random.default_rng(20240229).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a text column and the offset of each text (null: empty)."""
    column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None else np.empty(0, np.uint8)
    return raw, at - at[0]


def slices(
    batches: Iterator[pa.RecordBatch], column: str, limit: int = SLICE_BYTES
) -> Iterator[pa.RecordBatch]:
    """Runs of rows with at most ``limit`` bytes of text, or a single longer text."""
    for batch in batches:
        _, at = flat(batch.column(column))
        row = 0
        while row < batch.num_rows:
            end = int(np.searchsorted(at, at[row] + limit, side="right")) - 1
            end = min(max(end, row + 1), batch.num_rows)
            yield batch.slice(row, end - row)
            row = end


class Words:
    """Words of many texts: byte range and text of each, in order."""

    def __init__(self, raw: np.ndarray, offsets: np.ndarray, inside: np.ndarray):
        mask = inside[raw]
        before = np.empty_like(mask)
        before[:1] = False
        before[1:] = mask[:-1]
        starts_of_texts = offsets[:-1]
        before[starts_of_texts[starts_of_texts < len(raw)]] = False
        after = np.empty_like(mask)
        after[-1:] = False
        after[:-1] = mask[1:]
        ends_of_texts = offsets[1:]
        after[ends_of_texts[ends_of_texts > 0] - 1] = False
        self.start = np.flatnonzero(mask & ~before)
        self.end = np.flatnonzero(mask & ~after) + 1
        self.text = np.searchsorted(offsets, self.start, side="right") - 1
        self.texts = len(offsets) - 1
        #: Words of text i: bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.text, np.arange(self.texts + 1))

    def __len__(self) -> int:
        return len(self.start)

    def shingles(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of each run of ``size`` words and the bounds of each text's runs; a text with
        fewer words has one run of all of them, one without words has none."""
        counts = self.counts
        runs = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
        bounds = np.concatenate([[0], np.cumsum(runs)])
        owner = np.repeat(np.arange(self.texts), runs)
        first = self.bounds[owner] + np.arange(bounds[-1]) - bounds[owner]
        length = np.minimum(counts[owner], size)
        out = np.zeros(len(first), np.uint64)
        for k in range(size):
            inside = k < length
            at = np.where(inside, first + k, 0)
            out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + np.where(inside, hashes[at], 0)) if len(at) else out
        return out, bounds

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


_tables: list[np.ndarray] = []


def powers(size: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of them; kept for later slices."""
    if not _tables or len(_tables[0]) < size:
        room = (size // (1 << 18) + 1) << 18
        _tables[:] = []
        for base in (_BASE, _BASE_INVERSE):
            steps = np.full(room, base, np.uint64)
            steps[0] = 1
            _tables.append(np.cumprod(steps, dtype=np.uint64))
    return _tables


def mixed(values: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every bit of the result depends on every bit of the value."""
    values = values ^ (values >> np.uint64(32))
    values = values * np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    values *= np.uint64(0xD6E8FEB86659FD93)
    values ^= values >> np.uint64(32)
    return values


class Hashes:
    """64-bit hashes of any byte ranges of a buffer in constant time each."""

    def __init__(self, raw: np.ndarray):
        up, self._down = powers(len(raw) + 1)
        self._sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE_CODES[raw] * up[: len(raw)], dtype=np.uint64, out=self._sums[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self._sums[end] - self._sums[start]) * self._down[start] + (end - start).astype(np.uint64))


def per_text_sum(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the values of each text, 0 where it has none."""
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])
    return sums[bounds[1:]] - sums[bounds[:-1]]


def per_text(reduce: np.ufunc, values: np.ndarray, bounds: np.ndarray, empty) -> np.ndarray:
    """A reduction over the values of each text, ``empty`` where it has none."""
    out = np.full(len(bounds) - 1, empty, values.dtype)
    full = bounds[1:] > bounds[:-1]
    if full.any():
        out[full] = reduce.reduceat(values, bounds[:-1][full])
    return out
