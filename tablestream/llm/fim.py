"""Fill-in-middle: texts cut into prefix, middle and suffix at token boundaries.

Tokens are runs of ASCII letters and single other characters. A slice of texts has one learned rank
index over all its boundaries: the boundary's number leads to its byte offset by a piecewise linear
function, fitted so that no boundary is further than ``BOUND`` bytes from its line, and the distance
that is left is stored as one signed byte a boundary. A cut is predicted by the line of its segment
and corrected by the stored residual, which is exact.

Segments are fitted greedily: from its first boundary a segment takes as many as one slope can
serve (a cone that narrows with each boundary). A token longer than the bound ends a segment.

Cases: a null text counts as empty and an empty text is plain, as is one that holds a sentinel;
a null id counts as ''; rows that are repeated are cut alike. Columns of the input that are named
like new ones are replaced. An empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablestream.llm.textarrays import flat, slices

#: Fixed values of the format.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred texts, how many are cut at all, and how many of those start with the suffix.
CUT, SUFFIX_FIRST = 90, 20
BOUND = 127
REACH = 1 << 14  # boundaries that a segment is tried on at once

LETTER = np.zeros(256, bool)
LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
NAMES = ["n", "form", "prefix_chars", "middle_chars", "output"]


@dataclass
class RankIndex:
    """Offsets by rank: ``first`` rank, ``base`` offset and ``slope`` of each segment, residuals by rank."""

    first: np.ndarray
    base: np.ndarray
    slope: np.ndarray
    residual: np.ndarray

    @classmethod
    def fit(cls, offsets: np.ndarray, bound: int = BOUND) -> RankIndex:
        """``offsets``: at least one, ascending; ``bound`` of at most 127."""
        first, slope = [], []
        at, n = 0, len(offsets)
        while at < n:
            low, high, end = -np.inf, np.inf, at + 1
            while end < n:
                steps = np.arange(end - at, min(end + REACH, n) - at)
                rise = offsets[end : end + len(steps)] - offsets[at]
                # Half a byte is left for rounding the prediction.
                above = np.minimum(np.minimum.accumulate((rise + bound - 0.5) / steps), high)
                below = np.maximum(np.maximum.accumulate((rise - bound + 0.5) / steps), low)
                fits = int(np.searchsorted(below > above, True))
                if fits:
                    low, high = below[fits - 1], above[fits - 1]
                    end += fits
                if fits < len(steps):
                    break
            first.append(at)
            slope.append((low + high) / 2 if end > at + 1 else 0.0)
            at = end
        index = cls(np.array(first), offsets[first], np.array(slope), np.zeros(n, np.int8))
        index.residual = (offsets - index.predicted(np.arange(n))).astype(np.int8)
        return index

    def predicted(self, ranks: np.ndarray) -> np.ndarray:
        segment = np.searchsorted(self.first, ranks, side="right") - 1
        line = (ranks - self.first[segment]) * self.slope[segment]
        return self.base[segment] + np.rint(line).astype(np.int64)

    def __call__(self, ranks: np.ndarray) -> np.ndarray:
        return self.predicted(ranks) + self.residual[ranks]


def boundaries(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Byte offsets of all token boundaries of the texts, ends included, and each text's first number."""
    letter = LETTER[raw]
    inner = (raw & 0xC0) == 0x80
    inner[1:] |= letter[1:] & letter[:-1]
    inner[offsets[:-1][offsets[:-1] < len(raw)]] = False
    starts = np.flatnonzero(~inner)
    before = np.searchsorted(starts, offsets)
    # The end of text i comes after its own tokens and after the ends of the texts before.
    return np.insert(starts, before[1:], offsets[1:]), before[:-1] + np.arange(len(offsets) - 1)


def draws(doc_id: Column, seed: int = 1) -> list[Column]:
    """Four unsigned numbers of 32 bits for a document."""
    name = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    digest = F.sha2(name.cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def transform(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", seed: int = 1) -> DataFrame:
    """Add ``n`` (tokens), ``form`` (plain, psm or spm), ``prefix_chars``, ``middle_chars`` (null if
    plain) and ``output``, the text with its parts in the order of its form."""
    docs = docs.drop(*NAMES)
    drawn = [f"_draw{k}" for k in range(4)]
    while set(drawn) & set(docs.columns):
        drawn = [f"_{name}" for name in drawn]
    rows = docs.select("*", *(h.alias(name) for h, name in zip(draws(F.col(doc_id), seed), drawn, strict=True)))
    marks, names = tuple(m.encode() for m in (PREFIX, SUFFIX, MIDDLE)), [*docs.columns, *NAMES]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p, s, m = marks
        for part in slices(batches, text):
            raw, offsets = flat(part.column(text))
            cuts, base = boundaries(raw, offsets)
            index = RankIndex.fit(cuts)
            n = np.diff(np.append(base, len(cuts))) - 1
            h = [part.column(name).to_numpy() for name in drawn]
            one, two = h[0] % (n + 1), h[1] % (n + 1)
            left, right = index(base + np.minimum(one, two)), index(base + np.maximum(one, two))
            chars = np.concatenate([[0], np.cumsum((raw & 0xC0) != 0x80)])
            data = raw.tobytes()
            forms, outputs = [], []
            for k in range(part.num_rows):
                whole = data[offsets[k] : offsets[k + 1]]
                if not whole or h[2][k] % 100 >= CUT or any(mark in whole for mark in marks):
                    forms.append("plain")
                    outputs.append(whole.decode())
                    continue
                a, b = left[k] - offsets[k], right[k] - offsets[k]
                before, middle, after = whole[:a], whole[a:b], whole[b:]
                spm = h[3][k] % 100 < SUFFIX_FIRST
                forms.append("spm" if spm else "psm")
                joined = [s, after, p, before, m, middle] if spm else [p, before, s, after, m, middle]
                outputs.append(b"".join(joined).decode())
            plain = np.array([f == "plain" for f in forms], bool)
            yield pa.RecordBatch.from_arrays(
                [
                    *part.drop_columns(drawn).columns,
                    pa.array(n, pa.int64()),
                    pa.array(forms, pa.string()),
                    pa.array(chars[left] - chars[offsets[:-1]], pa.int64(), mask=plain),
                    pa.array(chars[right] - chars[left], pa.int64(), mask=plain),
                    pa.array(outputs, pa.string()),
                ],
                names=names,
            )

    added = StructType.fromDDL("n long, form string, prefix_chars long, middle_chars long, output string")
    return rows.mapInArrow(run, StructType([*docs.schema.fields, *added.fields]))


def restored(output: Column, form: Column) -> Column:
    """The text that was cut: its parts between the sentinels of the output, in their first order."""

    def between(start: str, end: str | None) -> Column:
        rest = F.substring_index(output, start, -1)
        return F.substring_index(rest, end, 1) if end else rest

    psm = F.concat(between(PREFIX, SUFFIX), between(MIDDLE, None), between(SUFFIX, MIDDLE))
    spm = F.concat(between(PREFIX, MIDDLE), between(MIDDLE, None), between(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
