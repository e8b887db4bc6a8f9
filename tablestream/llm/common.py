"""Column expressions and distributed numbering shared by the operators of this subpackage."""

from __future__ import annotations

import string
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablestream.session import cut_lineage, run_dir

WORD = r"[^\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    return F.translate(text, string.ascii_uppercase, string.ascii_lowercase)


def words(text: Column) -> Column:
    """Runs of anything but ASCII white space; null or blank texts have none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, however often the body uses it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Rows set aside: crc32 of the id as text modulo ``modulus``; a null id counts as ''."""
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return crc % modulus == remainder


@contextmanager
def plain_plans(spark: SparkSession) -> Iterator[None]:
    """Loops over checkpoints, whose plans would otherwise gather the constraints of every round."""
    name = "spark.sql.constraintPropagation.enabled"
    before = spark.conf.get(name, "true")
    spark.conf.set(name, "false")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def stored(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder. For loops: the size of a table that was read is
    its own, while estimates carried through checkpoints multiply from join to join."""
    path = run_dir(df.sparkSession, "stage")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[Column], name: str) -> tuple[DataFrame, int]:
    """Row numbers from 0 over the whole table, and the number of rows.

    Rows are spread by range and sorted in place; the number within a partition is part of the
    generated id, and a table of one count per partition carries the rest. Equal rows get numbers
    in any order.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("__id", F.monotonically_increasing_id())
    )
    place = F.shiftright("__id", 33)
    counts = placed.groupBy(place.alias("__slice")).agg(F.count(F.lit(1)).alias("__n"))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = cut_lineage(
        counts.select(
            "__slice", "__n", F.coalesce(F.sum("__n").over(earlier), F.lit(0)).alias("__carried")
        )
    )
    total = before.agg(F.sum("__n")).first()[0] or 0
    rows = (
        placed.withColumn("__slice", place)
        .join(F.broadcast(before.drop("__n")), "__slice")
        .withColumn(name, F.col("__carried") + F.col("__id").bitwiseAND((1 << 33) - 1))
    )
    return rows.select(*df.columns, name), int(total)


def running(df: DataFrame, order: list[Column], value: str, name: str) -> DataFrame:
    """The sum of ``value`` over all rows before each row in the order, of whatever groups.

    Spread by range like ``numbered``, so no group is held by one task.
    """
    placed = cut_lineage(
        df.repartitionByRange(*order).withColumn("__slice", F.spark_partition_id())
    )
    totals = placed.groupBy("__slice").agg(F.sum(value).alias("__total"))
    earlier = Window.orderBy("__slice").rowsBetween(Window.unboundedPreceding, -1)
    before = totals.select("__slice", F.sum("__total").over(earlier).alias("__carried"))
    inside = (
        Window.partitionBy("__slice").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    zero = F.lit(0)
    return (
        placed.withColumn("__inside", F.sum(value).over(inside))
        .join(F.broadcast(before), "__slice")
        .withColumn(name, F.coalesce("__inside", zero) + F.coalesce("__carried", zero))
        .select(*df.columns, name)
    )
