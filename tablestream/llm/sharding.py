"""Reproducible shuffles into shards: a Feistel permutation of global row numbers.

Row numbers come from one range shuffle of narrow rows. The permutation works on the smallest
rectangle ``a x b`` (a = ceil(sqrt(rows))) that holds all row numbers; a point outside the numbers
walks on along its cycle until it is back inside. Shard and slot are then arithmetic on the new
position, so the place of any row can be computed from its number alone.
"""

from __future__ import annotations

import math
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablestream.llm.common import numbered

PRIME = 2_147_483_647
MULTIPLIER = 1_103_515_245
ROUNDS = 8


def round_keys(seed: int) -> list[int]:
    return [zlib.crc32(f"{seed}:{k}".encode()) % PRIME for k in range(ROUNDS)]


def rectangle(rows: int) -> tuple[int, int]:
    a = math.isqrt(rows - 1) + 1 if rows > 1 else 1
    return a, max(1, -(-rows // a))


def walk_steps(rows: int) -> int:
    """Steps after which no cycle is outside: the points outside bound it, and so does chance.

    A step lands outside with probability below rows**-0.5, so beyond this many steps the chance
    that any row is still outside is below 2**-64; such a run fails instead of placing it wrongly.
    """
    a, b = rectangle(rows)
    outside = a * b - rows
    by_chance = 2 + math.ceil(128 / max(1.0, math.log2(rows))) if rows > 1 else 1
    return max(1, min(outside + 1, by_chance))


def permuted(number: Column, rows: int, seed: int) -> Column:
    """The place of a row number (0 .. rows-1) after the shuffle: a bijection on the numbers."""
    a, b = rectangle(rows)
    steps = F.array(
        *[
            F.struct(F.lit(key).cast("long").alias("key"), F.lit(m).cast("long").alias("m"))
            for key, m in zip(round_keys(seed), [a, b] * (ROUNDS // 2), strict=True)
        ]
    )

    def mixed(value: Column, key: Column) -> Column:
        t = (value + key) % PRIME
        return ((t * t) % PRIME * MULTIPLIER + key) % PRIME

    def half_round(s: Column, k: Column) -> Column:
        return F.struct(
            s["right"].alias("left"),
            ((s["left"] + mixed(s["right"], k["key"])) % k["m"]).alias("right"),
        )

    def once(x: Column) -> Column:
        # Whole-number division, exact for any number of rows.
        left = F.call_function("div", x, F.lit(b).cast("long"))
        start = F.struct(left.alias("left"), (x % b).alias("right"))
        return F.aggregate(steps, start, half_round, lambda s: s["left"] * b + s["right"])

    first = once(number)
    walked = F.aggregate(
        F.sequence(F.lit(1), F.lit(walk_steps(rows))),
        first,
        lambda x, _: F.when(x < rows, x).otherwise(once(x)),
    )
    return F.when(walked < rows, walked).otherwise(
        F.raise_error(F.lit("cycle walk did not end")).cast("long")
    )


def shard_rows(
    df: DataFrame, order: list[Column], shards: int, seed: int = 17
) -> DataFrame:
    """Add ``row_number``, ``position``, ``shard`` and ``slot``.

    Law: shard sizes in rows differ by at most one, and slots have no gaps. The order must end in
    a unique column for rows that differ; rows equal in all columns are interchangeable. Rows with
    null keys come first in the order; an empty table stays empty. Columns of the input named like
    new ones are replaced, so the order can't use them.
    """
    df = df.drop("row_number", "position", "shard", "slot")
    rows, total = numbered(df, order, "row_number")
    position = permuted(F.col("row_number"), total, seed) if total else F.lit(0).cast("long")
    return (
        rows.withColumn("position", position)
        .withColumn("shard", (F.col("position") % shards).cast("int"))
        .withColumn("slot", F.expr(f"position div {shards}"))
    )
