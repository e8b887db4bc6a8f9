"""Daily states: mergeable statistics per day, from which any range of days is answered.

A state holds counts, mean and squared deviations, extremes, a quantile sketch and a distinct sketch
of a field on one day. States of several days merge exactly but for the sketches, so a report reads
one row a day, key and field instead of the readings, and late or corrected readings cost the days they
fall on. Quantiles are off by about 1.3 % in rank at ``SKETCH`` = 200 (KLL), distinct counts by about
1.6 % at 2 to the 12th registers (HLL); all other fields are exact.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions.predicates import date_range
from tablestream.operators.quality import ANY
from tablestream.sources.writers import write_partitions

SKETCH, REGISTERS = 200, 12
QUANTILES = (0.05, 0.5, 0.95)


def daily_states(
    df: DataFrame, keys: list[str], ts: str, fields: list[str], ranges: dict[str, tuple[float, float]] | None = None
) -> DataFrame:
    """One state per key, day and field. Rows without a time have no day and count nowhere; text that
    is no number counts as NULL, but for its distinct values. All fields are side by side in one
    aggregate; only its few rows are turned long."""
    wide = []
    for name in fields:
        value = F.col(name).try_cast("double")
        low, high = (ranges or {}).get(name, ANY)
        wide.append(
            F.struct(
                F.lit(name).alias("field"),
                F.count(F.lit(1)).alias("rows"),
                F.count(value).alias("n"),
                F.count_if((value < low) | (value > high)).alias("out_of_range"),
                F.avg(value).alias("mean"),
                (F.var_pop(value) * F.count(value)).alias("squares"),
                F.min(value).alias("low"),
                F.max(value).alias("high"),
                F.kll_sketch_agg_double(value, SKETCH).alias("quantiles"),
                F.hll_sketch_agg(F.col(name).cast("string"), REGISTERS).alias("distinct"),
            ).alias(f"_{name}")
        )
    timed = df.filter(F.col(ts).isNotNull())
    grouped = timed.groupBy(*keys, F.to_date(ts).alias("date")).agg(*wide)
    entries = F.explode(F.array(*(F.col(f"_{name}") for name in fields))).alias("_state")
    return grouped.select(*keys, "date", entries).select(*keys, "date", "_state.*")


def _quantile(sketch: Column, share: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(share))


def merged(states: DataFrame, group: list[str]) -> DataFrame:
    """The statistics of each group of states, usually ``field`` and some keys over a range of days."""
    n, mean = F.col("n"), F.col("mean")
    total, middle = F.sum("n"), F.sum(mean * n) / F.sum("n")
    # Squared deviations within the days, and of the days' means from the mean of all.
    squares = F.sum("squares") + F.sum(n * mean * mean) - total * middle * middle
    out = states.groupBy(*group).agg(
        F.sum("rows").alias("total"),
        (F.sum("rows") - total).alias("null_count"),
        total.alias("non_null"),
        F.sum("out_of_range").alias("out_of_range"),
        F.min("low").alias("min_value"),
        F.max("high").alias("max_value"),
        F.when(total > 0, middle).alias("avg_value"),
        F.when(total > 1, F.sqrt(F.greatest(squares, F.lit(0.0)) / (total - 1))).alias("std_dev"),
        F.kll_merge_agg_double(F.when(n > 0, F.col("quantiles"))).alias("_quantiles"),
        F.hll_sketch_estimate(F.hll_union_agg("distinct")).alias("distinct_values"),
    )
    has = F.col("non_null") > 0
    shares = {f"q{round(100 * q):02d}": F.when(has, _quantile(F.col("_quantiles"), q)) for q in QUANTILES}
    return out.withColumns(shares).drop("_quantiles")


def over_range(
    states: DataFrame, group: list[str], start: date | None = None, end: date | None = None
) -> DataFrame:
    """Statistics over the days from ``start`` to ``end``; only their partitions are read."""
    return merged(date_range(states, "date", start, end), group)


def days_of(rows: DataFrame, ts: str) -> list[date]:
    """The days that rows fall on, which are at most as many as the calendar has."""
    found = rows.filter(F.col(ts).isNotNull()).select(F.to_date(ts).alias("date")).distinct()
    return sorted(r["date"] for r in found.collect())


def refresh(
    readings: DataFrame, path: str, keys: list[str], ts: str, fields: list[str], days: list[date] | None = None,
    ranges: dict[str, tuple[float, float]] | None = None,
) -> None:
    """Write the states of ``days`` (all, if None) anew from the readings, in place of theirs in the
    table at ``path``; states of other days stay as they are. A repeated refresh changes nothing."""
    if days is not None:
        if not days:
            return
        # The bounds reach the scan; the list of days does the rest.
        readings = date_range(readings, ts, days[0], days[-1]).filter(F.to_date(ts).isin(days))
    states = daily_states(readings, keys, ts, fields, ranges)
    write_partitions(states, path, ["date"], keys)


def read_states(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def state_profile(states: DataFrame) -> DataFrame:
    """Null and range profile of each field over all days of the states, with sketched quantiles and
    distinct values: the report of a month reads thirty rows a key and field."""
    return merged(states, ["field"]).withColumns(
        {
            "null_percentage": F.when(F.col("total") > 0, F.col("null_count") * 100.0 / F.col("total")).otherwise(0.0),
            "out_of_range_percentage": F.when(
                F.col("non_null") > 0, F.col("out_of_range") * 100.0 / F.col("non_null")
            ).otherwise(0.0),
        }
    )
