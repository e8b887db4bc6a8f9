"""Data tests, profiles and the status report."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, timedelta

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.session import cut_lineage

# Plausible range per field.
RANGES = {
    "temperature": (-50.0, 60.0),
    "avg_temperature": (-50.0, 60.0),
    "humidity": (0.0, 100.0),
    "avg_humidity": (0.0, 100.0),
    "pressure": (800.0, 1200.0),
    "avg_pressure": (800.0, 1200.0),
}

ANY = (float("-inf"), float("inf"))

# Percentages above which a table gets a warning or fails.
NULL_WARNING, NULL_FAIL = 5.0, 10.0
RANGE_WARNING, RANGE_FAIL = 1.0, 5.0
MISSING_FAIL = 10.0

_NAMES = ["PASS", "WARNING", "FAIL"]


def null_rows(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def repeated_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Values that occur more than once; NULL is not a value."""
    rows = df.dropna(subset=columns)
    return rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def unaccepted_rows(df: DataFrame, column: str, values: list) -> DataFrame:
    return df.filter(~F.col(column).isin(values))


def passes(offending: DataFrame) -> bool:
    """A test query passes when it returns no row."""
    return offending.isEmpty()


def column_tests(df: DataFrame, tests: dict[str, Column]) -> DataFrame:
    """Failing rows of several row-wise tests in one pass: one row per test."""
    counts = df.agg(*[F.count_if(bad).alias(name) for name, bad in tests.items()])
    entries = [
        F.struct(F.lit(name).alias("test"), F.col(name).alias("failures")) for name in tests
    ]
    return counts.select(F.inline(F.array(*entries)))


def unique_test(df: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The number of repeated values, in the form of ``column_tests``."""
    found = repeated_values(df, columns).agg(F.count(F.lit(1)).alias("failures"))
    return found.select(F.lit(name).alias("test"), "failures")


def _percent(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part * 100.0 / whole).otherwise(F.lit(0.0))


def profile(df: DataFrame, fields: dict[str, tuple[float, float]]) -> DataFrame:
    """Null and range profile, one row per field, from one pass over the table."""
    wide = []
    for name, (low, high) in fields.items():
        value = F.col(name)
        wide.append(
            F.struct(
                F.lit(name).alias("field"),
                F.count(F.lit(1)).alias("total"),
                F.count_if(value.isNull()).alias("null_count"),
                F.count(value).alias("non_null"),
                F.count_if((value < low) | (value > high)).alias("out_of_range"),
                F.min(value).alias("min_value"),
                F.max(value).alias("max_value"),
                F.avg(value).alias("avg_value"),
                F.stddev(value).alias("std_dev"),
            ).alias(f"_{name}")
        )
    rows = df.agg(*wide).select(F.inline(F.array(*[F.col(f"_{name}") for name in fields])))
    return rows.withColumns(
        {
            "null_percentage": _percent(F.col("null_count"), F.col("total")),
            "out_of_range_percentage": _percent(F.col("out_of_range"), F.col("non_null")),
        }
    )


def null_profile(df: DataFrame, fields: list[str]) -> DataFrame:
    return profile(df, dict.fromkeys(fields, ANY)).select(
        "field", "total", "null_count", "non_null", "null_percentage"
    )


def range_profile(df: DataFrame, fields: dict[str, tuple[float, float]]) -> DataFrame:
    return profile(df, fields).select(
        "field", F.col("non_null").alias("total"), "out_of_range", "out_of_range_percentage",
        "min_value", "max_value", "avg_value", "std_dev",
    )


@dataclass
class Checked:
    """A table to report on; ``df`` is None when it does not exist."""

    df: DataFrame | None
    day: Column
    fields: list[str]


def _severity(percent: Column, warning: float, fail: float) -> Column:
    return F.when(percent > fail, 2).when(percent > warning, 1).otherwise(0)


def _table_severity(
    name: str, table: Checked, keys: DataFrame, key: str, as_of: date, days: int
) -> DataFrame:
    """One row: the table, its missing pairs and its severity. One pass over the table, by day and
    key first; everything else runs on those few rows."""
    start = as_of - timedelta(days=days - 1)
    counts = {}
    for field in table.fields:
        low, high = RANGES.get(field, ANY)
        value = F.col(field)
        counts[f"_null_{field}"] = F.count_if(value.isNull())
        counts[f"_out_{field}"] = F.count_if((value < low) | (value > high))
    cells = table.df.groupBy(table.day.alias("_day"), key).agg(
        F.count(F.lit(1)).alias("_rows"), *[c.alias(n) for n, c in counts.items()]
    )
    expected = keys.select(key).distinct()
    known = expected.withColumn("_expected", F.lit(True))
    seen = F.col("_expected") & F.col("_day").between(F.lit(start), F.lit(as_of))
    totals = cells.join(known, key, "left").agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("_rows"),
        F.count_if(seen).alias("_seen"),
        *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in counts],
    )
    cells_wanted = expected.agg(F.count(F.lit(1))).scalar() * days
    missing = (cells_wanted - F.col("_seen")).alias("missing")
    rows = totals.select("*", missing, cells_wanted.alias("_wanted"))
    shares = [_severity(_percent(F.col("missing"), F.col("_wanted")), 0.0, MISSING_FAIL)]
    for field in table.fields:
        nulls, total = F.col(f"_null_{field}"), F.col("_rows")
        shares.append(_severity(_percent(nulls, total), NULL_WARNING, NULL_FAIL))
        out = _percent(F.col(f"_out_{field}"), total - nulls)
        shares.append(_severity(out, RANGE_WARNING, RANGE_FAIL))
    return rows.select(
        F.lit(name).alias("table"),
        F.col("missing").cast("long").alias("missing"),
        F.greatest(*shares).alias("_severity"),
        F.lit(None).cast("string").alias("_note"),
    )


def _note(spark: SparkSession, name: str, note: str, severity: int) -> DataFrame:
    return spark.range(1).select(
        F.lit(name).alias("table"),
        F.lit(None).cast("long").alias("missing"),
        F.lit(severity).alias("_severity"),
        F.lit(note).alias("_note"),
    )


def quality_report(
    spark: SparkSession,
    tables: dict[str, Checked],
    keys: DataFrame,
    key: str,
    as_of: date,
    days: int = 7,
) -> DataFrame:
    """Status per table and, in the row named ``overall``, the worst of them.

    An absent table is NOT_FOUND and does not change the overall status; one that cannot be
    analysed (a field is gone, its files can't be read) is ERROR and fails it.
    """
    parts = None
    for name, table in tables.items():
        if table.df is None:
            part = _note(spark, name, "NOT_FOUND", 0)
        else:
            try:
                # One row, counted here, so that errors of the run count as well.
                part = cut_lineage(_table_severity(name, table, keys, key, as_of, days))
            except (PySparkException, Py4JJavaError):
                part = _note(spark, name, "ERROR", 2)
        parts = part if parts is None else parts.unionByName(part)
    whole = F.grouping("table") == 1
    level = F.max("_severity")
    status = F.get(F.array(*[F.lit(n) for n in _NAMES]), level)
    return parts.rollup("table").agg(
        F.when(~whole, F.first("missing")).alias("missing"),
        F.when(whole, status).otherwise(F.coalesce(F.first("_note"), status)).alias("status"),
        whole.alias("_whole"),
    ).select(
        F.when(F.col("_whole"), "overall").otherwise(F.col("table")).alias("table"),
        "missing",
        "status",
    )


def decode_or_keep(messages: DataFrame, ddl: str, value: str = "value") -> DataFrame:
    """Typed columns of each message in one pass; one that does not fit the schema has NULL
    columns and is kept as it came in ``dead_letter``."""
    parsed = messages.withColumn(
        "_parsed",
        F.from_json(
            F.col(value).cast("string"), f"{ddl}, _corrupt string",
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"},
        ),
    )
    bad = F.col("_parsed").isNull() | F.col("_parsed._corrupt").isNotNull()
    rest = [name for name in messages.columns if name != value]
    marked = parsed.withColumns(
        {
            "dead_letter": F.when(bad, F.col(value).cast("string")),
            "_parsed": F.when(~bad, F.col("_parsed")),
        }
    )
    return marked.select(*rest, "_parsed.*", "dead_letter").drop("_corrupt")


def split_undecodable(
    messages: DataFrame, ddl: str, value: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Typed rows and dead letters."""
    rest = [name for name in messages.columns if name != value]
    rows = decode_or_keep(messages.filter(F.col(value).isNotNull()), ddl, value)
    good = rows.filter("dead_letter IS NULL").drop("dead_letter")
    return good, rows.filter("dead_letter IS NOT NULL").select(*rest, "dead_letter")
