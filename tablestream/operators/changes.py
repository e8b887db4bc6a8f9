"""Keyed changes, unique loads and versioned snapshots on plain tables.

The plain functions return the new state; write it to a new place, never over the table being read.
Those on bucketed tables replace the partitions that are touched, from a copy written before.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablestream.session import cut_lineage
from tablestream.sources.files import exists, remove
from tablestream.sources.writers import write_partitions


def _existence_after(op: Column) -> Column:
    """Whether the key exists after an insert or delete; NULL for an update, which keeps it."""
    return F.when(op == "I", True).when(op == "D", False)


def _blocked(changes: DataFrame, seq: str, block_rows: int) -> DataFrame:
    """Cut the log by quantiles of ``seq`` into blocks of about ``block_rows`` changes, however its
    numbers are spread. A sample is enough: borders decide how even the work is, no result."""
    rows = changes.count()
    blocks = -(-rows // block_rows)
    if blocks <= 1:
        return changes.withColumn("_block", F.lit(0.0))
    cuts = F.percentile_approx(
        F.col(seq).cast("double"), [i / blocks for i in range(1, blocks)], F.lit(100 * blocks)
    )
    share = min(1.0, 1000 * blocks / rows)
    found = changes.sample(share, seed=0).agg(cuts).first()[0] or []
    splits = [float("-inf"), *sorted(set(map(float, found))), float("inf")]
    at = changes.withColumn("_seq", F.col(seq).cast("double"))
    cut = Bucketizer(splits=splits, inputCol="_seq", outputCol="_block", handleInvalid="keep")
    return cut.transform(at).drop("_seq")


def _with_existence(
    target: DataFrame, changes: DataFrame, key: str, seq: str, block_rows: int
) -> DataFrame:
    """Mark each change with whether its key exists just before it.

    Only inserts and deletes matter for that. The log is cut into ranges of ``seq`` with about
    ``block_rows`` changes; the last insert or delete of a key in each is carried into the next.
    """
    turn = _existence_after(F.col("op"))
    marked = _blocked(changes, seq, block_rows)
    blocks = marked.groupBy(key, "_block").agg(
        F.max_by(turn, F.when(turn.isNotNull(), F.col(seq))).alias("_last")
    )
    earlier = Window.partitionBy(key).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    known = target.select(F.col(key).alias("_key"), F.lit(True).alias("_known"))
    carried = (
        blocks.withColumn("_carried", F.last("_last", ignorenulls=True).over(earlier))
        .join(known, F.col(key).eqNullSafe(F.col("_key")), "left")
        .select(F.col(key).alias("_of"), F.col("_block").alias("_in"), "_carried", "_known")
    )
    before = (
        Window.partitionBy(key, "_block").orderBy(seq).rowsBetween(Window.unboundedPreceding, -1)
    )
    state = F.coalesce(
        F.last(turn, ignorenulls=True).over(before),
        F.col("_carried"),
        F.col("_known"),
        F.lit(False),
    )
    return (
        marked.join(
            carried, F.col(key).eqNullSafe(F.col("_of")) & (F.col("_block") == F.col("_in"))
        )
        .withColumn("_exists", state)
        .drop("_block", "_carried", "_known", "_of", "_in")
    )


def apply_changes(
    target: DataFrame, changes: DataFrame, key: str, seq: str, block_rows: int = 100_000
) -> tuple[DataFrame, DataFrame]:
    """Apply inserts, partial updates and deletes in the order of ``seq`` (a unique number).

    ``changes`` has the columns of the target, ``seq`` and ``op`` (I, U or D). A NULL field of an
    update leaves the old value. Returns the new state and the changes that found no row to act
    on (or, for an insert, found one), with a ``reason``. NULL is a key like any other.
    """
    fields = [name for name in target.columns if name != key]
    # Used for the state and for what is rejected.
    marked = cut_lineage(_with_existence(target, changes, key, seq, block_rows))
    applies = F.when(F.col("op") == "I", ~F.col("_exists")).otherwise(F.col("_exists"))
    reason = F.when(F.col("op") == "I", "exists").otherwise("missing")
    rejected = marked.filter(~applies).drop("_exists").withColumn("reason", reason)

    # The newest word on each field: an update that sets it, or any insert or delete.
    turn = _existence_after(F.col("op"))
    newest = [
        F.max_by(
            F.struct(F.col(f).alias("value")), F.when(turn.isNotNull() | F.col(f).isNotNull(), F.col(seq))
        ).alias(f"_new_{f}")
        for f in fields
    ]
    last_turn = F.max_by(turn, F.when(turn.isNotNull(), F.col(seq))).alias("_exists")
    merged = marked.filter(applies).groupBy(F.col(key).alias("_key")).agg(last_turn, *newest)

    def value(f: str) -> Column:
        new = F.col(f"_new_{f}")
        kept = F.when(new.isNotNull(), new["value"]).otherwise(F.col(f))
        return kept.alias(f)

    old = target.withColumn("_old", F.lit(True))
    state = (
        old.join(merged, F.col(key).eqNullSafe(F.col("_key")), "full_outer")
        .filter(F.coalesce("_exists", F.lit(True)))
        .withColumn(key, F.when(F.col("_old"), F.col(key)).otherwise(F.col("_key")))
        .select(key, *[value(f) for f in fields])
        .select(*target.columns)
    )
    return state, rejected


def unique_on_load(
    existing: DataFrame, incoming: DataFrame, unique: list[str], seq: str
) -> tuple[DataFrame, DataFrame]:
    """Split incoming rows into accepted and rejected ones under a unique constraint.

    The first row of a value by ``seq`` (unique) is accepted unless the value exists already. As
    in SQL, a NULL never collides.
    """
    rows = _with_acceptance(existing, incoming, unique, seq)
    return rows.filter("accepted").drop("accepted"), rows.filter("NOT accepted").drop("accepted")


def _with_acceptance(existing, incoming, unique, seq):
    no_nulls = F.lit(True)
    for name in unique:
        no_nulls = no_nulls & F.col(name).isNotNull()
    winners = (
        incoming.filter(no_nulls)
        .groupBy(*unique)
        .agg(F.min(seq).alias(seq))
        .join(existing.select(*unique).distinct(), unique, "left_anti")
        .select(F.col(seq).alias("_winner"))
    )
    # Joined by the unique row number: a value with many copies stays spread out.
    return (
        incoming.join(winners, F.col(seq) == F.col("_winner"), "left")
        .withColumn("accepted", F.col("_winner").isNotNull() | ~no_nulls)
        .drop("_winner")
    )


def mark_unique(
    existing: DataFrame, incoming: DataFrame, unique: list[str], seq: str
) -> DataFrame:
    """The incoming rows with a column ``accepted``."""
    return _with_acceptance(existing, incoming, unique, seq)


def snapshot(
    history: DataFrame | None, current: DataFrame, key: str, updated_at: str
) -> DataFrame:
    """Versioned history: a row newer than the open version of its key closes it and opens another.

    ``valid_from`` and ``valid_to`` bound a version, an open one has no ``valid_to``. Keys that
    are not in ``current`` stay open. Of several rows of a key in ``current`` the newest counts, and
    of those with equal times the one with the greatest other columns. NULL is a key like any other.
    """
    columns = current.columns
    others = [name for name in columns if name not in (key, updated_at)]
    newest = current.groupBy(F.col(key)).agg(F.max(F.struct(updated_at, *others)).alias("_row"))
    opened = newest.select(F.col(key), "_row.*").select(*columns).withColumns(
        {"valid_from": F.col(updated_at), "valid_to": F.lit(None).cast(current.schema[updated_at].dataType)}
    )
    if history is None:
        return opened
    names = [*columns, "valid_from", "valid_to"]
    old = history.filter(F.col("valid_to").isNull()).select(
        F.col(key).alias("_was_key"), F.struct(*names).alias("_old")
    )
    new = opened.select(F.col(key).alias("_now_key"), F.struct(*names).alias("_new"))
    was, now = F.col("_old"), F.col("_new")
    newer = now[updated_at] > was[updated_at]
    versions = (
        F.when(was.isNull(), F.array(now))
        .when(newer, F.array(was.withField("valid_to", now[updated_at]), now))
        .otherwise(F.array(was))
    )
    same_key = F.col("_was_key").eqNullSafe(F.col("_now_key"))
    moved = old.join(new, same_key, "full_outer").select(F.explode(versions).alias("_row"))
    closed = history.filter(F.col("valid_to").isNotNull()).select(*names)
    return closed.unionByName(moved.select("_row.*"))


BUCKET = "bucket"


def with_bucket(df: DataFrame, key: str, buckets: int) -> DataFrame:
    """The rows with the partition that their key belongs to; a NULL key has one too."""
    return df.withColumn(BUCKET, F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))


def create_bucketed(df: DataFrame, path: str, key: str, buckets: int) -> None:
    """A table whose rows lie in ``buckets`` partitions by their key."""
    write_partitions(with_bucket(df, key, buckets), path, [BUCKET], [key])


def _rewritten(
    spark: SparkSession, path: str, touched: DataFrame, staged: str, compute: Callable[[DataFrame], DataFrame]
) -> None:
    """Replace the partitions of ``touched`` by what ``compute`` makes of their rows.

    The new rows are first written apart, and that copy is used as it is when the same batch is
    repeated: then only the replacement, which may be done twice, is done again. Partitions that are
    not touched keep their files.
    """
    if not exists(spark, f"{staged}/touched/_SUCCESS"):
        numbers = sorted(r[0] for r in touched.select(BUCKET).distinct().collect())  # at most all buckets
        rows = spark.read.parquet(path).filter(F.col(BUCKET).isin(numbers))
        compute(rows.drop(BUCKET)).write.mode("overwrite").partitionBy(BUCKET).parquet(f"{staged}/rows")
        named = spark.createDataFrame([(n,) for n in numbers], f"{BUCKET} int")
        named.coalesce(1).write.mode("overwrite").parquet(f"{staged}/touched")
    numbers = [r[0] for r in spark.read.parquet(f"{staged}/touched").collect()]
    if not numbers:
        return
    schema = spark.read.parquet(path).schema
    new = spark.read.schema(schema).parquet(f"{staged}/rows")
    write_partitions(new, path, [BUCKET])
    left = {r[0] for r in new.select(BUCKET).distinct().collect()}
    for number in numbers:
        # A partition without rows is not among those that a write replaces.
        if number not in left:
            remove(spark, f"{path}/{BUCKET}={number}")


def apply_to_buckets(
    spark: SparkSession, path: str, changes: DataFrame, key: str, seq: str, buckets: int, staged: str
) -> DataFrame:
    """``apply_changes`` on a bucketed table, of which only the partitions with changed keys are read
    and rewritten. Returns the rejected changes. ``staged`` is a folder of this batch of changes; with
    it a batch that was interrupted can be repeated."""

    def compute(rows: DataFrame) -> DataFrame:
        state, rejected = apply_changes(rows, changes, key, seq)
        rejected.write.mode("overwrite").parquet(f"{staged}/rejected")
        return with_bucket(state, key, buckets)

    _rewritten(spark, path, with_bucket(changes, key, buckets), staged, compute)
    return spark.read.parquet(f"{staged}/rejected")


def snapshot_to_buckets(
    spark: SparkSession, path: str, current: DataFrame, key: str, updated_at: str, buckets: int, staged: str
) -> None:
    """``snapshot`` on a bucketed history: only partitions with a key of ``current`` are rewritten."""

    def compute(rows: DataFrame) -> DataFrame:
        return with_bucket(snapshot(rows, current, key, updated_at), key, buckets)

    _rewritten(spark, path, with_bucket(current, key, buckets), staged, compute)


def add_rows(existing: DataFrame, new: DataFrame) -> DataFrame:
    return existing.unionByName(new)
