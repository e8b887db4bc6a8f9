"""Sorting, limits and the best or newest rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tablestream.functions.predicates import date_range
from tablestream.operators.joins import matching
from tablestream.operators.ordered import number_rows


def rank_newest(df: DataFrame, key: str, ts: str, tie: str, name: str = "row_num") -> DataFrame:
    """All rows with their rank by time within the key, newest first."""
    return number_rows(df, [key], [F.desc(ts), F.desc(tie)], name)


def rank_by_period(
    df: DataFrame, key: str, ts: str, period: str = "minute", name: str = "row_num"
) -> DataFrame:
    """``rank_newest`` as a plan that runs when it is read, for a bounded stretch of time.

    Rows are ranked within their period, and the counts of newer periods are added: a task holds a
    period of a key or, of a key, one count a period. Equal times are ordered by the other columns.
    """
    names = ["_period", "_of", "_in", "_newer"]
    rest = [F.col(c) for c in df.columns if c not in (key, ts)]
    rows = df.withColumn("_period", F.date_trunc(period, ts))
    counts = rows.groupBy(F.col(key).alias("_of"), F.col("_period").alias("_in")).agg(F.count(F.lit(1)).alias("_n"))
    newer = Window.partitionBy("_of").orderBy(F.desc("_in")).rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_of", "_in", F.coalesce(F.sum("_n").over(newer), F.lit(0)).alias("_newer"))
    inside = Window.partitionBy(key, "_period").orderBy(F.desc(ts), *rest)
    same = F.col(key).eqNullSafe(F.col("_of")) & F.col("_period").eqNullSafe(F.col("_in"))
    ranked = rows.withColumn(name, F.row_number().over(inside)).join(before, same)
    return ranked.withColumn(name, F.col(name) + F.col("_newer")).drop(*names)


def newest_per_key(df: DataFrame, keys: list[str], ts: str, tie: str) -> DataFrame:
    """The newest row of each key, the one with the largest ``tie`` among equals.

    The newest times are a hash aggregate over narrow columns; only rows of that time are compared
    in full. NULL is a key like any other; without any time, a key's rows are all of the newest.
    """
    newest = df.groupBy(*keys).agg(F.max(ts).alias(ts))
    rest = [name for name in df.columns if name not in keys]
    row = F.max_by(F.struct(*rest), tie).alias("_row")
    latest = matching(df, newest, [*keys, ts]).groupBy(*keys).agg(row)
    return latest.select(*keys, "_row.*").select(*df.columns)


def top_n(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)


def newest_rows(
    df: DataFrame, ts: str, tie: str, start=None, end=None, city: str | None = None, n: int = 100
) -> DataFrame:
    rows = date_range(df, ts, start, end)
    if city is not None:
        rows = rows.filter(F.col("city_name") == city)
    return top_n(rows, [F.desc(ts), F.desc(tie)], n)


def top_n_per_group(df: DataFrame, group: list[str], order: list[Column], n: int) -> DataFrame:
    """The first rows of each group in a total order. Spark limits each group before the shuffle,
    so no task sees more than n rows of it per input partition."""
    place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    return df.withColumn("rank", place).filter(F.col("rank") <= n)
