"""Stream sinks. Each returns a started query; ``available=True`` reads what is there and stops."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tablestream.operators.joins import matching
from tablestream.sources.files import remove
from tablestream.sources.writers import TEXT_TIMES, write_jdbc


# Fixed value: time between batches to a relational table.
JDBC_INTERVAL = "1000 milliseconds"


def _start(
    df: DataFrame, checkpoint: str, available: bool, mode: str = "append", interval: str | None = None
):
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    if available:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=interval) if interval else writer


def to_files(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition: list[str] | None = None,
    available: bool = False,
) -> StreamingQuery:
    """Exactly-once append to files, optionally below partition folders."""
    writer = _start(df, checkpoint, available).format(fmt).option("path", path)
    if fmt in ("csv", "json"):
        writer = writer.options(header=True, **TEXT_TIMES)
    if partition:
        writer = writer.partitionBy(*partition)
    return writer.start()


def to_landing(df: DataFrame, root: str, checkpoint: str, ts: str, available: bool = False):
    """JSON files below one folder per day."""
    dated = df.withColumn("date", F.to_date(ts))
    return to_files(dated, root, checkpoint, "json", ["date"], available)


def to_console(df: DataFrame, checkpoint: str, mode: str) -> StreamingQuery:
    return _start(df, checkpoint, False, mode).format("console").option("truncate", False).start()


def to_topic(
    df: DataFrame,
    checkpoint: str,
    target: str = "kafka",
    options: Mapping[str, str] | None = None,
    available: bool = False,
) -> StreamingQuery:
    """Rows as JSON messages, at least once. ``target`` may be ``text`` with a ``path``."""
    messages = df
    if df.columns != ["value"]:
        messages = df.select(F.to_json(F.struct("*"), TEXT_TIMES).alias("value"))
    writer = _start(messages, checkpoint, available).format(target)
    return writer.options(**dict(options or {})).start()


def to_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    available: bool = False,
    interval: str | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``write``, which must give the same result when repeated.

    ``interval`` (``JDBC_INTERVAL`` for a relational table) is the time between batches."""
    return _start(df, checkpoint, available, mode, interval).foreachBatch(write).start()


def to_complete_table(df: DataFrame, path: str, checkpoint: str, available: bool = False):
    """Complete mode: the table is the whole result after each batch. A batch counts once its mark
    is written, so a reader never sees a part of one. Only the newest result and, for those who
    are still reading it, the one before are kept."""

    def replace(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")
        mark = spark.range(batch_id, batch_id + 1, numPartitions=1)
        mark.toDF("batch").write.mode("overwrite").parquet(f"{path}/_done/batch-{batch_id}")
        for old in (f"{path}/_done/batch-{batch_id - 2}", f"{path}/batch={batch_id - 2}"):
            remove(spark, old)

    return to_batches(df, replace, checkpoint, "complete", available)


def to_update_log(df: DataFrame, path: str, checkpoint: str, available: bool = False):
    """Update mode: the changed rows of each batch; ``read_updates`` gives the newest of each."""

    def log(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return to_batches(df, log, checkpoint, "update", available)


def read_updates(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    log = spark.read.parquet(path)
    newest = log.groupBy(*keys).agg(F.max("batch").alias("batch"))
    return matching(log, newest, [*keys, "batch"]).drop("batch")


def read_complete(spark: SparkSession, path: str) -> DataFrame:
    done = spark.read.parquet(f"{path}/_done/*").agg(F.max("batch")).first()[0]
    return spark.read.parquet(f"{path}/batch={done}")


def fan_out(
    df: DataFrame,
    writes: list[Callable[[DataFrame, int], None]],
    checkpoint: str,
    available: bool = False,
) -> StreamingQuery:
    """One stream into several sinks: each batch is read once and kept while all are served."""

    def serve(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writes:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return to_batches(df, serve, checkpoint, "append", available)


def batch_files(path: str, shape: Callable[[DataFrame], DataFrame], fmt: str = "parquet"):
    """A writer for ``fan_out``: one folder per batch, replaced when the batch is repeated."""

    def write(batch: DataFrame, batch_id: int) -> None:
        shape(batch).write.mode("overwrite").format(fmt).save(f"{path}/batch={batch_id}")

    return write


def _known_keys(spark: SparkSession, url: str, table: str, key: str) -> DataFrame:
    have = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return have.load().select(key)


def jdbc_batches(url: str, table: str, key: str, batch_size: int = 200, retries: int = 5):
    """A writer of rows with a unique key to a relational table.

    Only the first batch of a run and a retried one can repeat rows; those are compared with the
    keys in the table first, all others are appended as they are.
    """
    may_repeat = True

    def write(batch: DataFrame, batch_id: int) -> None:
        nonlocal may_repeat
        for attempt in range(retries + 1):
            rows = batch.dropDuplicates([key])
            try:
                if may_repeat:
                    known = _known_keys(batch.sparkSession, url, table, key)
                    rows = rows.join(known, key, "left_anti")
                write_jdbc(rows, url, table, "append", batch_size)
            except Exception:
                may_repeat = True
                if attempt == retries:
                    raise
            else:
                may_repeat = False
                return

    return write
