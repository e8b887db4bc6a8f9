"""Streams with keyed state: silence after an alert, running counts, single delivery and late rows.

All go by event time. A row is late if its time is not after the watermark, the newest time seen in
earlier batches less ``lateness``; late rows reach no state. As long as no row is older than that, the
results don't depend on how the rows are cut into batches, and a restart continues from the
checkpoint. State is dropped once the watermark makes it useless.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout
from pyspark.sql.types import IntegralType, NumericType, StringType, StructField, StructType

from tablestream.sources.writers import TEXT_TIMES
from tablestream.streaming.sinks import to_batches

LATENESS = "10 minutes"
NO_TIME = np.iinfo(np.int64).min
# Fixed value: windows of a key that are neighbours in one slot of the running counts.
STRETCH = 60


def _silence(period: int):
    """Per key: last emitted time and the events that the watermark has not reached yet."""

    def decide(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last, times, ties, bodies = state.get if state.exists else (NO_TIME, [], [], [])
        times, ties, bodies = list(times), list(ties), list(bodies)
        if not state.hasTimedOut:
            for chunk in chunks:
                times += chunk["us"].tolist()
                ties += chunk["tie"].tolist()
                bodies += chunk["body"].tolist()
        reached = state.getCurrentWatermarkMs() * 1000
        order = sorted(range(len(times)), key=lambda k: (times[k], ties[k]))
        due = [k for k in order if times[k] <= reached]
        stamps = np.array([times[k] for k in due], np.int64)
        sent, at = [], 0
        while True:
            if last != NO_TIME:
                at = max(at, int(np.searchsorted(stamps, last + period, side="left")))
            if at >= len(due):
                break
            last = int(stamps[at])
            sent.append(bodies[due[at]])
            at += 1
        waiting = order[len(due) :]
        if waiting or (last != NO_TIME and last + period > reached):
            state.update((last, *([column[k] for k in waiting] for column in (times, ties, bodies))))
            until = times[waiting[0]] if waiting else last + period
            state.setTimeoutTimestamp(max(until // 1000, reached // 1000))
        elif state.exists:
            state.remove()
        if sent:
            yield pd.DataFrame({"body": sent})

    return decide


def cooled_down(
    events: DataFrame, keys: list[str], ts: str, tie: str, seconds: int = 3600, lateness: str = LATENESS
) -> DataFrame:
    """The events that are emitted when each one silences its key for ``seconds``, as in the batch
    ``cooldown``: of events with equal key and time the one with the least ``tie`` (a whole number)
    counts as first, and one exactly ``seconds`` after the last emitted one is emitted again.

    Events wait in the state until the watermark reaches them and are then decided in the order of
    their time. A key without waiting events leaves the state ``seconds`` after its last emission.
    Null keys are keys; events without a time are dropped. One task follows a key within a batch; for
    keys beyond that, ``live_alerts`` runs the batch cool-down, which splits them.
    """
    timed = events.filter(F.col(ts).isNotNull()).withWatermark(ts, lateness)
    body = F.to_json(F.struct(*events.columns), {**TEXT_TIMES, "ignoreNullFields": "false"})
    narrow = timed.select(
        *keys, ts, F.unix_micros(ts).alias("us"), F.col(tie).cast("long").alias("tie"), body.alias("body")
    )
    sent = narrow.groupBy(*keys).applyInPandasWithState(
        _silence(seconds * 1_000_000),
        "body string",
        "last long, us array<long>, tie array<long>, body array<string>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return sent.select(F.from_json("body", events.schema, TEXT_TIMES).alias("_event")).select("_event.*")


def running_counts_in_window(
    events: DataFrame, key: str, ts: str, tie: str, seconds: int = 60, expires: str = "120 seconds",
    slots: int = 1024,
) -> DataFrame:
    """Each event (``tie``, ``key``, ``ts``) with the start of its window and how many events of its
    key and window there are up to it: those of earlier batches, and of its own batch those before
    it by time and ``tie``. A window leaves the state once it is over and ``expires`` has passed.

    A call costs far more than a row, so keys share ``slots`` states (and as many for null keys), which
    are dealt out by key and stretch of ``STRETCH`` windows: calls and state rows don't grow with the
    number of keys, and a frequent key spreads over its stretches. A task holds one slot of a batch at
    a time; ``slots`` is fixed for the life of a checkpoint.
    """

    period = seconds * 1_000_000
    kinds = {name: events.schema[name].dataType for name in (tie, key)}
    own = isinstance(kinds[key], (NumericType, StringType))  # other kinds of keys pass as JSON

    def count(group: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, starts, counts = state.get if state.exists else ([], [], [])
        starts, counts = np.array(starts, np.int64), np.array(counts, np.int64)
        names, rows = pd.Series(names, dtype=None if len(names) else object), None
        if not state.hasTimedOut:
            rows = pd.concat(list(chunks)).sort_values(["us", "untied", "tie"])
            old, us = len(names), rows["us"].to_numpy()
            names = pd.concat([names.astype(rows["name"].dtype), rows["name"]], ignore_index=True)
            starts = np.concatenate([starts, us - us % period])
            # An entry of the state stands for as many rows as it has counted, before all others.
            weight = np.concatenate([counts, np.ones(len(rows), np.int64)])
            who = pd.factorize(names)[0]
            order = np.lexsort((starts, who))  # stable
            first = np.ones(len(order), bool)
            first[1:] = (np.diff(who[order]) != 0) | (np.diff(starts[order]) != 0)
            total = np.cumsum(weight[order])
            before = (total - weight[order])[first]
            number = np.empty(len(order), np.int64)
            number[order] = total - before[np.cumsum(first) - 1]
            yield pd.DataFrame(
                {"tie": rows["tie"].to_numpy(), "untied": rows["untied"].to_numpy(), "name": rows["name"].to_numpy(),
                 "unnamed": group[0] < 0, "us": us, "window_us": starts[old:], "n": number[old:]}
            )
            last = order[np.append(first[1:], True)]
            names, starts, counts = names.iloc[last], starts[last], number[last]
        open_ = (starts + period) // 1000 > state.getCurrentWatermarkMs()
        if open_.any():
            state.update((names[open_].tolist(), starts[open_].tolist(), counts[open_].tolist()))
            state.setTimeoutTimestamp(int(starts[open_].min() + period) // 1000)
        elif state.exists:
            state.remove()

    # Whole numbers with nulls among them would reach pandas as floats.
    whole = isinstance(kinds[tie], IntegralType)
    filled = F.coalesce(F.col(tie), F.lit(0).cast(kinds[tie])) if whole else F.col(tie)
    if own:
        name, kind = F.coalesce(F.col(key), F.lit(0).cast(kinds[key])), kinds[key].simpleString()
    else:
        name, kind = F.to_json(F.struct(F.col(key).alias("key")), TEXT_TIMES), "string"
    us = F.unix_micros(ts)
    stretch = us - F.pmod(us, F.lit(STRETCH * period))
    slot = F.pmod(F.xxhash64(name, stretch), F.lit(slots)).cast("int")
    narrow = events.filter(F.col(ts).isNotNull()).withWatermark(ts, expires).select(
        F.when(F.col(key).isNull(), -1 - slot).otherwise(slot).alias("slot"), name.alias("name"),
        filled.alias("tie"), F.col(tie).isNull().alias("untied"), ts, us.alias("us"),
    )
    counted = narrow.groupBy("slot").applyInPandasWithState(
        count,
        f"tie {kinds[tie].simpleString()}, untied boolean, name {kind}, unnamed boolean, us long, window_us long, n long",
        f"names array<{kind}>, windows array<long>, counts array<long>",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    found = F.col("name")
    if not own:
        found = F.from_json("name", StructType([StructField("key", kinds[key])]), TEXT_TIMES)["key"]
    return counted.select(
        F.when(~F.col("untied"), F.col("tie")).alias(tie), F.when(~F.col("unnamed"), found).alias(key),
        F.timestamp_micros("us").alias(ts), F.timestamp_micros("window_us").alias("window_start"),
        F.col("n").alias("events_so_far"),
    )


def once(events: DataFrame, message_id: str, ts: str, lateness: str = LATENESS) -> DataFrame:
    """Each message once, of a source that delivers it at least once.

    Repeats are recognised while the first copy is not older than ``lateness``; ids leave the state
    after that, so its size follows the rate of messages and not their number."""
    return events.withWatermark(ts, lateness).dropDuplicatesWithinWatermark([message_id])


def keep_late(
    events: DataFrame, ts: str, seconds: int, path: str, checkpoint: str, available: bool = False
) -> StreamingQuery:
    """Split a stream into rows in time and late rows, which would vanish in a windowed aggregate.

    Late is a row whose time is not after the newest time of earlier batches less ``seconds``; it is
    kept below ``path/late`` with ``late_by`` (seconds behind that mark). All others, those without a
    time included, are below ``path/kept``. Each batch writes its own folders and the newest time,
    so a repeated batch replaces what it wrote before. ``read_kept`` and ``read_late`` read finished
    batches alone."""

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        mark = None
        if batch_id > 0:
            mark = spark.read.parquet(f"{path}/newest/batch={batch_id - 1}").first()["us"]
        us = F.unix_micros(ts)
        batch.persist()
        try:
            if mark is None:
                kept, late = batch, batch.withColumn("late_by", F.lit(0.0)).limit(0)
            else:
                behind = F.lit(mark - seconds * 1_000_000) - us
                is_late = F.coalesce(behind >= 0, F.lit(False))
                kept = batch.filter(~is_late)
                late = batch.filter(is_late).withColumn("late_by", behind / 1_000_000)
            kept.write.mode("overwrite").parquet(f"{path}/kept/batch={batch_id}")
            late.write.mode("overwrite").parquet(f"{path}/late/batch={batch_id}")
            newest = batch.agg(F.greatest(F.max(us), F.lit(mark).cast("long")).alias("us"))
            newest.write.mode("overwrite").parquet(f"{path}/newest/batch={batch_id}")
        finally:
            batch.unpersist()

    return to_batches(events, split, checkpoint, "append", available)


def _finished(df: DataFrame, path: str) -> DataFrame:
    done = df.sparkSession.read.parquet(f"{path}/newest").select("batch").distinct()
    return df.join(F.broadcast(done), "batch", "left_semi").drop("batch")  # a number a batch


def read_kept(spark, path: str) -> DataFrame:
    return _finished(spark.read.parquet(f"{path}/kept"), path)


def read_late(spark, path: str) -> DataFrame:
    return _finished(spark.read.parquet(f"{path}/late"), path)
