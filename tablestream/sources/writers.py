"""Batch sinks and table layout."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date, timedelta

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BinaryType,
    DateType,
    StringType,
    StructType,
    TimestampNTZType,
    TimestampType,
)

# Days a table keeps its partitions.
RETENTION_DAYS = {
    "weather_streaming": 30,
    "weather_streaming_hourly": 30,
    "weather_analytics": 180,
}


# Text formats keep milliseconds unless told otherwise.
TEXT_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).options(**TEXT_TIMES).csv(path)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).parquet(path)


def jdbc_options(url: str, table: str, batch_size: int, extra: Mapping[str, str] | None) -> dict:
    return {"url": url, "dbtable": table, "batchsize": str(batch_size), **dict(extra or {})}


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 200,
    options: Mapping[str, str] | None = None,
) -> None:
    df.write.format("jdbc").options(**jdbc_options(url, table, batch_size, options)).mode(
        mode
    ).save()


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """The rows with a counter that is filled by whichever write runs them."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def layout(df: DataFrame, partition: list[str], cluster: list[str]) -> DataFrame:
    """Rows arranged for a partitioned write, sorted by the clustering columns within files.

    The rebalance hint gathers each partition's rows into few files, and adaptive execution splits
    a partition that holds far more rows than the others.
    """
    if partition:
        df = df.hint("rebalance", *partition)
    if partition or cluster:
        df = df.sortWithinPartitions(*partition, *cluster)
    return df


def _as_number(df: DataFrame, name: str) -> Column:
    """A column as a double in its order; of text and bytes the first six bytes count."""
    kind = df.schema[name].dataType
    if isinstance(kind, (StringType, BinaryType)):
        head = F.rpad(F.substring(F.col(name).cast("binary"), 1, 6), F.lit(6), F.lit(b"\0"))
        return F.conv(F.hex(head), 16, 10).cast("double")
    if isinstance(kind, DateType):
        return F.unix_date(name).cast("double")
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(F.col(name).cast("timestamp")).cast("double")
    return F.col(name).cast("double")


def interleaved(df: DataFrame, columns: list[str], name: str, bits: int = 8) -> DataFrame:
    """Add ``name``, a key whose ranges are narrow in all ``columns`` and not only in the first.

    Each column is ranked among 2 to the ``bits`` quantiles of its own, found in one pass, and the
    bits of the ranks are woven together. NULL ranks last.
    """
    steps = 1 << bits
    cuts = [k / steps for k in range(1, steps)]
    wanted = [F.percentile_approx(_as_number(df, c), cuts, F.lit(20 * steps)).alias(c) for c in columns]
    found = df.agg(*wanted).first()
    key, ranked, made = F.lit(0).cast("long"), df, []
    for at, column in enumerate(columns):
        number, rank = f"{name}_number{at}", f"{name}_rank{at}"
        made += [number, rank]
        splits = [float("-inf"), *(sorted(set(found[column] or [])) or [0.0]), float("inf")]
        cut = Bucketizer(splits=splits, inputCol=number, outputCol=rank, handleInvalid="keep")
        ranked = cut.transform(ranked.withColumn(number, _as_number(df, column)))
        for bit in range(bits + 1):
            one = F.shiftright(F.col(rank).cast("long"), bit).bitwiseAND(F.lit(1).cast("long"))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(columns) + at))
    return ranked.withColumn(name, key).drop(*made)


def interleaved_layout(df: DataFrame, columns: list[str], files: int, bits: int = 8) -> DataFrame:
    """Rows in ``files`` ranges of the interleaved key, sorted by it: a filter on any of ``columns``
    skips most row groups, where a plain sort serves its first column alone."""
    name = "_interleaved"
    while any(c.startswith(name) for c in df.columns):
        name = f"_{name}"
    placed = interleaved(df, columns, name, bits)
    return placed.repartitionByRange(files, name).sortWithinPartitions(name).drop(name)


def create_layout(
    df: DataFrame, table: str, partition: list[str], cluster: list[str], mode: str = "overwrite"
) -> None:
    writer = layout(df, partition, cluster).write.mode(mode).format("parquet")
    writer.partitionBy(*partition).saveAsTable(table)


def append_table(df: DataFrame, table: str) -> None:
    """Append to a table by column name, creating it when missing."""
    df.write.mode("append").saveAsTable(table)


def load_table(
    df: DataFrame,
    tables: Mapping[str, str],
    key: str,
    disposition: str = "APPEND",
    partition: list[str] | None = None,
    cluster: list[str] | None = None,
) -> int:
    """Load rows into the table named by ``key`` and return how many were written.

    EMPTY refuses a table that has rows. A missing table is created, with the given layout. The
    count comes from the write itself.
    """
    if key not in tables:
        raise ValueError(f"unknown table key: {key}")
    if disposition not in ("APPEND", "TRUNCATE", "EMPTY"):
        raise ValueError(f"unknown disposition: {disposition}")
    spark, table = df.sparkSession, tables[key]
    exists = spark.catalog.tableExists(table)
    if disposition == "EMPTY" and exists and not spark.table(table).isEmpty():
        raise ValueError(f"table {table} is not empty")
    rows, seen = counted(df)
    rows = layout(rows, partition or [], cluster or [])
    if not exists:
        rows.write.partitionBy(*partition or []).saveAsTable(table)
    else:
        ordered = rows.select(*spark.table(table).columns)
        ordered.write.insertInto(table, overwrite=disposition == "TRUNCATE")
    return seen.get["rows"]


def write_partitions(
    df: DataFrame, path: str, partition: list[str], cluster: list[str] | None = None
) -> None:
    """Write partitioned files; partitions present in the rows replace those on disk, all others
    stay."""
    (
        layout(df, partition, cluster or [])
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition)
        .parquet(path)
    )


def replace_partition(df: DataFrame, table: str, column: str, day: date) -> None:
    """Replace one day of a partitioned table by these rows, all others stay."""
    spark = df.sparkSession
    names = [name for name in spark.table(table).columns if name != column]
    spark.sql(
        f"INSERT OVERWRITE {table} PARTITION ({column} = DATE'{day}') SELECT * FROM {{rows}}",
        rows=df.select(*names),
    )


def expire_partitions(
    spark: SparkSession, table: str, column: str, days: int, as_of: date
) -> list[str]:
    """Drop the day partitions older than ``days`` before ``as_of``; returns the dropped days."""
    oldest = (as_of - timedelta(days=days)).isoformat()
    listed = [row.partition for row in spark.sql(f"SHOW PARTITIONS {table}").collect()]
    found = [p.split("=", 1)[1] for p in listed if p.startswith(f"{column}=")]
    expired = sorted(day for day in found if day < oldest)
    for start in range(0, len(expired), 100):
        specs = ", ".join(f"PARTITION ({column}='{d}')" for d in expired[start : start + 100])
        spark.sql(f"ALTER TABLE {table} DROP IF EXISTS {specs}")
    return expired


def ensure_table(spark: SparkSession, table: str, schema: StructType | str) -> list[str]:
    """Create the table when missing, else add its missing columns at the end; never drops one.

    Returns the names added to an existing table.
    """
    empty = spark.createDataFrame([], schema)
    if not spark.catalog.tableExists(table):
        empty.write.saveAsTable(table)
        return []
    have = {name.lower() for name in spark.table(table).columns}
    new = [field for field in empty.schema.fields if field.name.lower() not in have]
    if new:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in new)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [field.name for field in new]


def create_view(df: DataFrame, name: str) -> None:
    df.createOrReplaceTempView(name)


def save_model(df: DataFrame, table: str) -> None:
    df.write.mode("overwrite").saveAsTable(table)


def append_files(df: DataFrame, path: str) -> None:
    """Add rows to a CSV data set kept as a directory; each file has its own header."""
    write_csv(df, path, "append")
