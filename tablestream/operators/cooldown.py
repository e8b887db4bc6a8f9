"""Alert cool-down: after an emitted event of a key, its events are silent for a while.

Each decision hangs on the last *emitted* event, so a key is a chain. Time is cut into periods as
long as the cool-down: a chain emits at most once per period, and seen by its offset within the
period it only moves forward until it wraps. Each key is therefore split by offset into slices that
tasks follow independently across all periods:

1. per (key, slice), where does a chain leave the slice if it enters a cell (one slice of one
   period) at its first event;
2. per (key, stretch of periods), where can a chain leave the stretch. Chains soon meet, so these are
   few, about one for each slice at most;
3. per (key, stretch), what becomes of a chain that arrives from each of those places;
4. per key, walk from stretch to stretch;
5. per (key, stretch), walk the cells from the one entered;
6. per (key, slice), emit the events of the entered cells.

A task holds the rows of a slice, the cells of a stretch, or the arrivals of a key's stretches. Where
no key has more rows than a slice may hold, each key is one slice and followed in one step.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.session import cut_lineage
from tablestream.sources.writers import TEXT_TIMES

#: Cells of one stretch at most, as periods times slices.
STRETCH_CELLS = 1_000_000


def _steps(period: int, slices: int, stretch: int, keys: list[str]):
    """The per-group functions of the steps. They are closures over plain values, so they
    travel to executors that do not have this package."""

    def follow(times: np.ndarray, part: int):
        """For sorted event times of one slice: cell of each, its successor in the slice (itself
        when the chain leaves) and the first cell it may enter after leaving."""
        cells = (times // period) * slices + part
        after = cells + slices
        successor = np.searchsorted(times, times + period, side="left")
        found = np.minimum(successor, len(times) - 1)
        stays = (successor < len(times)) & (cells[found] == after)
        return cells, np.where(stays, found, np.arange(len(times))), after + 1

    def leaving(group: pd.DataFrame) -> pd.DataFrame:
        times = np.sort(group["_us"].to_numpy())
        cells, successor, leaves = follow(times, group["_part"].iloc[0])
        while True:
            further = successor[successor]
            if np.array_equal(further, successor):
                break
            successor = further
        entered, first = np.unique(cells, return_index=True)
        out = {k: [group[k].iloc[0]] * len(entered) for k in keys}
        return pd.DataFrame({**out, "_cell": entered, "_leave": leaves[successor[first]]})

    def left_by(cells: np.ndarray, leaves: np.ndarray) -> np.ndarray:
        """For sorted cells of a stretch: where a chain that enters by each leaves the stretch."""
        following = np.searchsorted(cells, leaves, side="left")
        onward = np.where(following < len(cells), following, np.arange(len(cells)))
        while True:
            further = onward[onward]
            if np.array_equal(further, onward):
                return leaves[onward]
            onward = further

    def crossing(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_cell")
        left = np.unique(left_by(group["_cell"].to_numpy(), group["_leave"].to_numpy()))
        out = {k: [group[k].iloc[0]] * len(left) for k in keys}
        return pd.DataFrame({**out, "_stretch": left // stretch, "_from": left})

    def arriving(group: pd.DataFrame, arrivals: pd.DataFrame) -> pd.DataFrame:
        names = [*keys, "_stretch", "_from", "_cell", "_leave"]
        if not len(group):
            return pd.DataFrame({n: arrivals[n] if n in arrivals else arrivals["_from"] for n in names})[:0]
        group = group.sort_values("_cell")
        cells, start = group["_cell"].to_numpy(), group["_stretch"].iloc[0] * stretch
        left = left_by(cells, group["_leave"].to_numpy())
        source = np.unique(np.append(arrivals["_from"].to_numpy(), start))
        at = np.searchsorted(cells, source, side="left")
        source, at = source[at < len(cells)], at[at < len(cells)]
        out = group.iloc[at][[*keys, "_stretch", "_cell"]].copy()
        out["_from"], out["_leave"] = source, left[at]
        return out[names]

    def entering(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_from")
        source, leaves = group["_from"].to_numpy(), group["_leave"].to_numpy()
        entered, at = [], 0
        while at < len(source):
            entered.append(at)
            # Where nothing follows in its stretch, the chain goes on by the first cell of the next.
            at = int(np.searchsorted(source, leaves[at], side="left"))
        return group.iloc[entered][[*keys, "_stretch", "_cell"]]

    def walking(group: pd.DataFrame, entry: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_cell")
        cells = group["_cell"].to_numpy()
        following = np.searchsorted(cells, group["_leave"].to_numpy(), side="left").tolist()
        visited = []
        for first in entry["_cell"]:
            at = int(np.searchsorted(cells, first, side="left"))
            while at < len(following):
                visited.append(at)
                at = following[at]
        return group.iloc[visited][[*keys, "_cell"]]

    def emitting(group: pd.DataFrame, entered: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_us")
        times = group["_us"].to_numpy()
        if not len(times):
            return group[[*keys, "_us", "_tie"]]
        cells, successor, _ = follow(times, group["_part"].iloc[0])
        sent = np.zeros(len(times), dtype=bool)
        for at in np.searchsorted(cells, entered["_cell"].to_numpy(), side="left").tolist():
            while True:
                sent[at] = True
                if successor[at] == at:
                    break
                at = successor[at]
        return group.loc[sent, [*keys, "_us", "_tie"]]

    return leaving, crossing, arriving, entering, walking, emitting


def _as_text(keys: list[str]) -> Column:
    """The key columns as one text that is never NULL, so that joins find NULL keys too."""
    return F.to_json(F.struct(*keys), {**TEXT_TIMES, "ignoreNullFields": "false"})


def _slices_for(times: DataFrame, keys: list[str], slice_rows: int) -> int:
    """Slices so that the largest key has about ``slice_rows`` rows in each."""
    per_key = times.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    largest = per_key.agg(F.max("n")).first()[0] or 0
    return max(1, -(-largest // slice_rows))


def _borders(times: DataFrame, slices: int) -> list[float]:
    """Offsets that cut the events into about equal slices. A sample is enough: the borders decide
    how even the work is, not what comes out."""
    if slices == 1:
        return []
    share = min(1.0, 1000 * slices / max(1, times.count()))
    cuts = F.percentile_approx(
        "_offset", [i / slices for i in range(1, slices)], F.lit(100 * slices)
    )
    found = times.sample(share, seed=0).agg(cuts).first()[0] or []
    return sorted(set(map(float, found)) - {0.0})


def _single(period: int):
    """The whole chain of a key in one task."""

    def chain(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values("_us")
        times = group["_us"].to_numpy()
        sent, at = [], 0
        while at < len(times):
            sent.append(at)
            at = int(np.searchsorted(times, times[at] + period, side="left"))
        return group.iloc[sent][["_key", "_us", "_tie"]]

    return chain


def _sent_schema(df: DataFrame, tie: str) -> str:
    return f"_key string, _us long, _tie {df.schema[tie].dataType.simpleString()}"


def _emitted(rows: DataFrame, sent: DataFrame, tie: str, columns: list[str]) -> DataFrame:
    by = ["_key", "_us", tie]
    emitted = rows.join(sent.withColumnRenamed("_tie", tie), by, "left_semi")
    return emitted.dropDuplicates(by).select(*columns)


def cooldown(
    df: DataFrame,
    keys: list[str],
    ts: str,
    tie: str,
    seconds: int = 3600,
    slices: int | None = None,
    last_sent: DataFrame | None = None,
    slice_rows: int = 1_000_000,
    stretch_cells: int = STRETCH_CELLS,
) -> DataFrame:
    """The rows that are emitted when each one silences its key for ``seconds``.

    Of rows with equal key and time the one with the smallest ``tie`` counts as first, and of
    copies that agree in all three any one. An event exactly ``seconds`` after the last emitted
    one is emitted again. ``last_sent`` (keys and ``last_sent``) continues from earlier batches.
    NULL is a key like any other.
    """
    period = seconds * 1_000_000
    columns, keys_as_text = df.columns, _as_text(keys)
    rows = df.withColumns({"_us": F.unix_micros(F.col(ts).cast("timestamp")), "_key": keys_as_text})
    keys = ["_key"]
    if last_sent is not None:
        since = last_sent.select(keys_as_text.alias("_key"), F.unix_micros("last_sent").alias("_since"))
        rows = (
            rows.join(since, keys, "left")
            .filter(F.col("_since").isNull() | (F.col("_us") >= F.col("_since") + period))
            .drop("_since")
        )
    # Far narrower than the rows, and used several times.
    times = cut_lineage(
        rows.groupBy(*keys, "_us")
        .agg(F.min(tie).alias("_tie"))
        .withColumn("_offset", F.pmod("_us", F.lit(period)).cast("double"))
    )
    if slices is None:
        slices = _slices_for(times, keys, slice_rows)
        if slices == 1:  # no key is too large for a task
            sent = times.groupBy(*keys).applyInPandas(_single(period), _sent_schema(df, tie))
            return _emitted(rows, sent, tie, columns)
    borders = _borders(times, slices)
    slices = len(borders) + 1
    if borders:
        splits = [float("-inf"), *borders, float("inf")]
        cut = Bucketizer(splits=splits, inputCol="_offset", outputCol="_part")
        sliced = cut.transform(times).withColumn("_part", F.col("_part").cast("int"))
    else:
        sliced = times.withColumn("_part", F.lit(0))
    sliced = sliced.select(*keys, "_part", "_us", "_tie")

    ddl = "_key string"
    stretch = max(1, stretch_cells // slices) * slices
    leave, cross, arrive, enter, walk, emit = _steps(period, slices, stretch, keys)
    leaving = sliced.groupBy(*keys, "_part").applyInPandas(
        leave, f"{ddl}, _cell long, _leave long"
    )
    leaving = leaving.withColumn("_stretch", F.floor(F.col("_cell") / stretch))
    leaving = cut_lineage(leaving)
    crossed = leaving.groupBy(*keys, "_stretch").applyInPandas(
        cross, f"{ddl}, _stretch long, _from long"
    )
    moves = (
        leaving.groupBy(*keys, "_stretch")
        .cogroup(crossed.groupBy(*keys, "_stretch"))
        .applyInPandas(arrive, f"{ddl}, _stretch long, _from long, _cell long, _leave long")
    )
    entries = moves.groupBy(*keys).applyInPandas(enter, f"{ddl}, _stretch long, _cell long")
    entered = (
        leaving.groupBy(*keys, "_stretch")
        .cogroup(entries.groupBy(*keys, "_stretch"))
        .applyInPandas(walk, f"{ddl}, _cell long")
    )
    entered = entered.withColumn("_part", F.pmod("_cell", F.lit(slices)).cast("int"))
    sent = (
        sliced.groupBy(*keys, "_part")
        .cogroup(entered.groupBy(*keys, "_part"))
        .applyInPandas(emit, _sent_schema(df, tie))
    )
    return _emitted(rows, sent, tie, columns)
