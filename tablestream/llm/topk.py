"""Exact nearest vectors by inner product with a vector-approximation file.

Equal vectors are one class; of its members only the k + 1 least ids can appear in a result. The
file holds one byte for each component of each class, its cell among 256 equal ones between the
least and the largest value of that component. Query blocks scan blocks of the file for bounds of
every score, twice: first for the k + 1 best lower bounds of each query, which are merged from block to
block into one bar, then for the vectors whose upper bound reaches it. Exact vectors are read in
the order of the upper bounds: first a few for each query, whose exact scores give the score of the
kth result at least, then those whose upper bound reaches it. What is left out is certain not to be
among the first k.

Cases: vectors that are null, or hold null, NaN or infinite components, and rows without an id take
no part; shorter vectors count as filled up with zeros, an empty one as all zeros. Equal scores go
to smaller ids. Rows with the id of a query are not its candidates. Of different vectors under the id
of a query the least one asks, by its first component, then the next; as candidates all of them
count. Without queries or candidates there are no rows. Scores beyond 64 bits end the query with an error.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.llm.common import stored

SCALE = 1024
CELLS = 256
DATA_BLOCK, QUERY_BLOCK = 4096, 256
#: Exact vectors read for each query before its bound is known, in multiples of k + 1.
FIRST_READ = 3


def whole_numbers(vector: Column) -> Column:
    return F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("long"))


def usable(vector: Column) -> Column:
    def odd(x: Column) -> Column:
        y = x.cast("double")
        return y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))

    return vector.isNotNull() & ~F.exists(vector, odd)


def dot(one: Column, two: Column) -> Column:
    zero = F.lit(0).cast("long")
    return F.aggregate(F.zip_with(one, two, lambda a, b: a * b), zero, lambda s, x: s + x)


def _blocks(rows: DataFrame, count: int, name: str) -> DataFrame:
    block = F.pmod(F.xxhash64("id"), F.lit(count)).cast("int")
    return rows.groupBy(block.alias(name)).agg(F.collect_list(F.struct("id", "v")).alias(f"{name}_rows"))


def _matrix(column: pa.ListScalar, dims: int) -> tuple[np.ndarray, np.ndarray]:
    rows = column.values
    values = rows.field("v").flatten().to_numpy(zero_copy_only=False)
    return rows.field("id").to_numpy(zero_copy_only=False), values.reshape(-1, dims)


def nearest(rows: DataFrame, k: int, is_query: Column) -> DataFrame:
    """``query_id``, ``rank``, ``vec_id``, ``score`` from rows of vec_id and embedding."""
    ready = rows.filter(F.col("vec_id").isNotNull() & usable(F.col("embedding"))).select(
        F.col("vec_id"), whole_numbers(F.col("embedding")).alias("v"), is_query.alias("asks")
    )
    ready = stored(ready)
    dims = ready.agg(F.max(F.size("v"))).first()[0] or 0
    if not dims:
        dims = 1
    zeros = F.array_repeat(F.lit(0).cast("long"), F.lit(dims) - F.size("v"))
    ready = ready.withColumn("v", F.concat("v", zeros))

    place = F.row_number().over(Window.partitionBy("v").orderBy("vec_id"))
    members = ready.select("vec_id", "v").distinct().withColumn("place", place).filter(F.col("place") <= k + 1)
    # A class has a number of its own, as its ids may belong to other vectors too.
    members = members.withColumn("row", F.monotonically_increasing_id())
    members = members.withColumn("id", F.min("row").over(Window.partitionBy("v")))
    members = stored(members.select("id", "vec_id", "place", "v"))
    classes = members.filter("place = 1").select("id", F.col("vec_id").alias("least"), "v")
    queries = stored(ready.filter("asks").select(F.col("vec_id").alias("id"), "v").groupBy("id").agg(F.min("v").alias("v")))

    edges = [F.min(F.get("v", F.lit(d))).alias(f"lo{d}") for d in range(dims)]
    edges += [F.max(F.get("v", F.lit(d))).alias(f"hi{d}") for d in range(dims)]
    ends = classes.agg(F.count(F.lit(1)).alias("n"), *edges).first()
    asked = queries.count()
    if not ends["n"] or not asked:
        return queries.select(
            F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
            F.lit(0).cast("long").alias("score"),
        ).limit(0)
    low = np.array([ends[f"lo{d}"] for d in range(dims)], np.int64)
    width = np.maximum(1, -(-(np.array([ends[f"hi{d}"] for d in range(dims)], np.int64) + 1 - low) // CELLS))
    data_blocks, query_blocks = -(-ends["n"] // DATA_BLOCK), -(-asked // QUERY_BLOCK)

    def approximated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k_row in range(batch.num_rows):
                ids, v = _matrix(batch.column("data_rows")[k_row], dims)
                cells = ((v - low) // width).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([ids], pa.list_(pa.int64())), pa.array([cells.tobytes()], pa.binary())],
                    names=["ids", "cells"],
                )

    file = stored(
        _blocks(classes, data_blocks, "data").mapInArrow(approximated, "ids array<long>, cells binary")
    )

    def bounds(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        asks, q = _matrix(row["query_rows"], dims)
        ids = row["ids"].values.to_numpy(zero_copy_only=False)
        cells = np.frombuffer(row["cells"].as_buffer(), np.uint8).reshape(-1, dims)
        least = low + cells.astype(np.int64) * width
        most = (least + width - 1).astype(np.float64)
        least, q = least.astype(np.float64), q.astype(np.float64)
        up, down = np.maximum(q, 0), np.minimum(q, 0)
        upper, lower = up @ most.T + down @ least.T, up @ least.T + down @ most.T
        slack = 1e-12 * np.maximum(np.abs(upper), np.abs(lower)) + 0.5
        return asks, ids, upper + slack, lower - slack

    def best(lower: np.ndarray) -> np.ndarray:
        """The k + 1 best lower bounds of each query, -inf where there are fewer."""
        if lower.shape[1] <= k + 1:
            return np.pad(lower, ((0, 0), (0, k + 1 - lower.shape[1])), constant_values=-np.inf)
        return np.partition(lower, lower.shape[1] - k - 1, axis=1)[:, -k - 1 :]

    def cells_of(batch: pa.RecordBatch) -> Iterator[dict]:
        for at in range(batch.num_rows):
            yield {name: batch.column(name)[at] for name in batch.schema.names}

    def lowest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in cells_of(batch):
                _, _, _, lower = bounds(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["query"].as_py()], pa.int32()), pa.array([row["part"].as_py()], pa.int32()),
                     pa.array([best(lower).tobytes()], pa.binary())],
                    names=["query", "part", "best"],
                )

    def merged(table: pa.Table) -> pa.Table:
        parts = [np.frombuffer(x, np.float64).reshape(-1, k + 1) for x in table.column("best").to_pylist()]
        return table.slice(0, 1).select(["query", "part"]).append_column(
            "best", pa.array([best(np.concatenate(parts, axis=1)).tobytes()], pa.binary())
        )

    def reaching(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in cells_of(batch):
                asks, ids, upper, _ = bounds(row)
                bar = np.frombuffer(row["best"].as_buffer(), np.float64).reshape(-1, k + 1).min(axis=1)
                a, b = np.nonzero(upper >= bar[:, None])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asks[a]), pa.array(ids[b]), pa.array(upper[a, b])], names=["query_id", "id", "upper"]
                )

    # Every block of the file meets every block of the stated queries, by block number.
    asking_blocks = stored(_blocks(queries, query_blocks, "query"))
    every = F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1)))
    spread = file.withColumn("query", every)

    def met(sides: DataFrame) -> DataFrame:
        return spread.join(sides, "query").repartition(max(1, data_blocks * query_blocks), "query", F.element_at("ids", 1))

    # The bounds of a query block are merged in two steps, each of at most some hundred blocks.
    part = F.pmod(F.xxhash64(F.element_at("ids", 1)), F.lit(max(1, math.isqrt(data_blocks)))).cast("int")
    kind = "query int, part int, best binary"
    lows = met(asking_blocks).withColumn("part", part).mapInArrow(lowest, kind)
    lows = lows.groupBy("query", "part").applyInArrow(merged, kind)
    lows = stored(lows.groupBy("query").applyInArrow(merged, kind).select("query", "best"))
    close = met(asking_blocks.join(lows, "query")).mapInArrow(reaching, "query_id long, id long, upper double")

    by_query = Window.partitionBy("query_id")
    close = stored(
        close.select(
            "query_id", "id", "upper",
            F.row_number().over(by_query.orderBy(F.desc("upper"), "id")).alias("turn"),
        )
    )
    asking = queries.select(F.col("id").alias("query_id"), F.col("v").alias("q"))

    def exact(pairs: DataFrame) -> DataFrame:
        read = pairs.join(asking, "query_id").join(classes, "id")
        return stored(read.select("query_id", "id", "least", dot(F.col("q"), F.col("v")).alias("score")))

    early = F.col("turn") <= FIRST_READ * (k + 1)
    first = exact(close.filter(early))
    place = F.row_number().over(by_query.orderBy(F.desc("score"), "least"))
    sure = first.withColumn("n", place).filter(F.col("n") == k + 1).select("query_id", F.col("score").alias("sure"))
    rest = close.filter(~early).join(sure, "query_id", "left").filter("sure IS NULL OR upper >= sure")
    scored = first.unionByName(exact(rest))
    # k classes besides the query's own hold all results.
    top = scored.withColumn("n", F.row_number().over(by_query.orderBy(F.desc("score"), "least"))).filter(F.col("n") <= k + 1)
    each = top.join(members.select("id", "vec_id"), "id").filter("vec_id != query_id")
    order = by_query.orderBy(F.desc("score"), "vec_id")
    return each.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
