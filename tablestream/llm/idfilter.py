"""A Bloom filter of ids, so that a scan passes on only the texts that a join may need.

What passes by chance falls out in the join that follows. The size is bounded: with too many ids
more passes, nothing is lost.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tablestream.llm.textarrays import mixed

#: Bits for each id, and at most: 32 MB.
BITS, MOST_BITS = 16, 1 << 28
PART = 1 << 16


def _places(ids: np.ndarray, bits: int) -> np.ndarray:
    """Three bits of the filter for each id."""
    codes = ids.astype(np.int64).view(np.uint64)
    steps = [np.uint64(k * 0x9E3779B97F4A7C15 % 2**64) for k in (1, 2, 3)]
    return (np.stack([mixed(codes ^ step) for step in steps]) % np.uint64(bits)).astype(np.int64)


@dataclass
class IdFilter:
    bits: np.ndarray

    @classmethod
    def of(cls, ids: DataFrame) -> IdFilter:
        """The filter of the only column of ``ids``; null ids never pass."""
        name = ids.columns[0]
        ids = ids.filter(f"`{name}` IS NOT NULL")
        bits = int(min(MOST_BITS, max(PART, 1 << (BITS * ids.count()).bit_length())))

        def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = np.unique(_places(batch.column(0).to_numpy(), bits))
                yield pa.RecordBatch.from_arrays([pa.array(at // PART), pa.array(at % PART)], names=["part", "at"])

        def merged(table: pa.Table) -> pa.Table:
            out = np.zeros(PART, bool)
            out[table.column("at").to_numpy()] = True
            part, packed = table.column("part")[:1], np.packbits(out).tobytes()
            return pa.table([part, pa.array([packed], pa.binary())], names=["part", "bits"])

        each = ids.mapInArrow(places, "part long, at long").distinct()
        parts = each.groupBy("part").applyInArrow(merged, "part long, bits binary")
        out = np.zeros((bits // PART, PART // 8), np.uint8)
        for row in parts.collect():  # the bits of the filter
            out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
        return cls(out.ravel())

    def lets(self, ids: pa.Array) -> pa.Array:
        """Whether each id may be one of those in the filter."""
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        at = _places(ids.fill_null(0).to_numpy(), 8 * len(self.bits))
        found = (self.bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1
        return pa.array(found.all(axis=0) & known)

    def passed(self, rows: DataFrame, name: str) -> DataFrame:
        """The rows whose id may be in the filter."""
        lets = self.lets

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(lets(batch.column(name)))

        return rows.mapInArrow(run, rows.schema)
