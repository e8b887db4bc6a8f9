"""Streams from message to table or topic."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

from tablestream.operators.alerts import LIMITS, Limits, explode_alerts
from tablestream.operators.cooldown import cooldown
from tablestream.sources.files import remove
from tablestream.streaming.sinks import to_batches

ALERT_KEYS = ["city_name", "alert_type"]


def table_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A Parquet table, one file or a folder of files, as a stream."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # The file source wants a folder or a pattern; this one matches the path alone.
    return reader.parquet(f"{path[:-1]}[{path[-1]}]")


def live_alerts(
    readings: DataFrame,
    path: str,
    checkpoint: str,
    tie: str,
    limits: Limits = LIMITS,
    seconds: int = 3600,
    available: bool = False,
    publish: Callable[[DataFrame, int], None] | None = None,
) -> StreamingQuery:
    """Readings to alerts that are silent for a while after each emitted one.

    Each micro-batch runs the batch cool-down, which splits busy keys over tasks, from the time
    every key last emitted. Alerts and times are written per batch, and a repeated batch replaces
    its own files, so a restart neither loses nor doubles an alert. ``publish`` also gets each
    batch of written alerts, at least once, for a topic or another table.

    A reading that comes in a later batch but is older than its key's last alert counts as within
    the silence; only readings within one batch are put in order.
    """

    def emit(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        alerts = explode_alerts(batch, limits).persist()
        previous = None
        if batch_id > 0:
            previous = spark.read.parquet(f"{path}/last_sent/batch={batch_id - 1}")
        sent = cooldown(alerts, ALERT_KEYS, "timestamp", tie, seconds, last_sent=previous)
        target = f"{path}/alerts/batch={batch_id}"
        sent.write.mode("overwrite").parquet(target)
        alerts.unpersist()
        written = spark.read.schema(sent.schema).parquet(target)
        newest = (
            written.groupBy(*ALERT_KEYS)
            .agg(F.max("timestamp").alias("last_sent"))
        )
        if previous is not None:
            newest = (
                newest.unionByName(previous)
                .groupBy(*ALERT_KEYS)
                .agg(F.max("last_sent").alias("last_sent"))
            )
        newest.write.mode("overwrite").parquet(f"{path}/last_sent/batch={batch_id}")
        # The batch before may be repeated; no other is read again.
        remove(spark, f"{path}/last_sent/batch={batch_id - 2}")
        if publish is not None:
            publish(written, batch_id)

    return to_batches(readings, emit, checkpoint, "append", available)


class BatchTimes(StreamingQueryListener):
    """Mean duration of the newest micro-batches, in milliseconds."""

    def __init__(self, keep: int = 60):
        self.times = deque(maxlen=keep)

    @property
    def mean(self) -> float | None:
        return sum(self.times) / len(self.times) if self.times else None

    def onQueryStarted(self, event):
        pass

    def onQueryProgress(self, event):
        self.times.append(event.progress.batchDuration)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        pass
