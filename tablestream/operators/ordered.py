"""Row numbers and trailing frames over groups of any size.

A plain window puts a whole group into one task. Here rows are first spread by range over key and
order together, so that a group holding a large share of the rows spans many slices, and only a
small table of per-slice counts is carried from one slice to the next.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.session import written


def number_rows(
    df: DataFrame, keys: list[str], order: list[Column], name: str = "row_num"
) -> DataFrame:
    """Number the rows of each key from 1 in a total order (end it with a unique column)."""
    by = [F.col(k) for k in keys]
    # Written once, which fixes the slice of each row; the counts read its keys and slices alone.
    placed = written(
        df.repartitionByRange(*by, *order).withColumn("_slice", F.spark_partition_id())
    )
    group = keys or [F.lit(0)]
    counts = placed.groupBy("_slice", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = (
        Window.partitionBy(*group).orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    )
    # Only the first key of a slice can go on from an earlier one: at most one row per slice.
    carried = (
        counts.withColumn("_before", F.sum("_rows").over(earlier))
        .filter("_before > 0")
        .select(
            F.col("_slice").alias("_s"), *[F.col(k).alias(f"_k_{k}") for k in keys], "_before"
        )
    )
    match = F.col("_slice") == F.col("_s")
    for k in keys:
        match = match & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    inside = F.row_number().over(Window.partitionBy("_slice", *keys).orderBy(*order))
    numbered = placed.withColumn("_inside", inside).join(F.broadcast(carried), match, "left")
    return numbered.select(
        *df.columns, (F.col("_inside") + F.coalesce("_before", F.lit(0))).alias(name)
    )


def trailing_mean(
    df: DataFrame,
    keys: list[str],
    order: list[Column],
    value: str,
    rows: int,
    name: str,
    block_rows: int = 100_000,
) -> DataFrame:
    """Mean of the last ``rows`` rows of each key, the current one included.

    Numbered rows are cut into blocks; the last rows of a block also travel to the next one, where
    they only complete the frames.
    """
    if block_rows < rows:
        raise ValueError("a block must be at least as long as the frame")
    numbered = number_rows(df, keys, order, "_n")
    block = F.floor((F.col("_n") - 1) / block_rows)
    place = (F.col("_n") - 1) % block_rows
    homes = F.when(place > block_rows - rows, F.array(block, block + 1)).otherwise(F.array(block))
    spread = numbered.select("*", block.alias("_home"), F.explode(homes).alias("_block"))
    frame = Window.partitionBy(*keys, "_block").orderBy("_n").rowsBetween(-(rows - 1), 0)
    return (
        spread.withColumn(name, F.avg(value).over(frame))
        .filter("_block = _home")
        .select(*df.columns, name)
    )
