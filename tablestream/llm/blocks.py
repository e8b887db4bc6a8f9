"""Documents packed into blocks: rows of a few MB that tasks can work on with flat arrays.

A block holds the ids and the compressed bytes of consecutive rows. Blocks get their number once, in
a checkpointed table, so that what other tasks find out about a block can be joined back to it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablestream.llm.textarrays import flat, slices
from tablestream.session import cut_lineage

SCHEMA = "ids array<long>, offsets binary, data binary, bytes long, rest binary"
ROWS = 30_000


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    squeeze = zstandard.ZstdCompressor(level=1)
    for piece in slices(batches, "text"):
        for row in range(0, piece.num_rows, ROWS):
            part = piece.slice(row, ROWS)
            raw, offsets = flat(part.column("text"))
            other = part.drop_columns(["doc_id", "text"])
            rest = None
            if other.num_columns:
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, other.schema) as writer:
                    writer.write_batch(other)
                rest = squeeze.compress(sink.getvalue())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([part.column("doc_id").to_pylist()], pa.list_(pa.int64())),
                    pa.array([offsets.tobytes()], pa.binary()),
                    pa.array([squeeze.compress(raw.tobytes())], pa.binary()),
                    pa.array([len(raw)], pa.int64()),
                    pa.array([rest], pa.binary()),
                ],
                names=["ids", "offsets", "data", "bytes", "rest"],
            )


def pack(docs: DataFrame) -> DataFrame:
    """``block``, ``ids``, ``offsets``, ``data``, ``bytes`` over all rows of doc_id and text; other
    columns go into ``rest``."""
    packed = docs.mapInArrow(_packed, SCHEMA)
    numbered = packed.withColumn("block", F.monotonically_increasing_id())
    return cut_lineage(numbered)


def opened(row: dict) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of the texts of a block."""
    offsets = np.frombuffer(row["offsets"], np.int64)
    if not offsets[-1]:
        return np.empty(0, np.uint8), offsets
    data = zstandard.ZstdDecompressor().decompress(row["data"], max_output_size=int(offsets[-1]))
    return np.frombuffer(data, np.uint8), offsets


def others(row: dict) -> dict[str, pa.Array]:
    """The other columns of a block's rows."""
    if row["rest"] is None:
        return {}
    data = zstandard.ZstdDecompressor().decompressobj().decompress(row["rest"])
    batch = next(iter(pa.ipc.open_stream(data)))
    return dict(zip(batch.schema.names, batch.columns, strict=True))


def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield {name: batch.column(name)[k].as_py() for name in batch.schema.names}
