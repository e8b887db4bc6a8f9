"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tablestream.schemas import RAW_WEATHER


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None) -> DataFrame:
    """CSV with a header. Types are inferred, at the price of a second pass, only when no schema
    is given."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_csv_text(spark: SparkSession, path: str) -> DataFrame:
    """CSV with a header, every column a string."""
    return spark.read.option("header", True).csv(path)


def with_types(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast text columns; text that does not fit becomes NULL."""
    return df.withColumns({name: F.col(name).try_cast(kind) for name, kind in types.items()})


def ingest_opportunities(df: DataFrame, as_of) -> DataFrame:
    """Typed opportunities from an all-text table.

    Dates are month/day/year, flags are the word TRUE in any case, and the status stamp is the
    load time where the text flag is TRUE. An empty table is refused.
    """
    if df.isEmpty():
        raise ValueError("no opportunities to load")

    def day(name):
        return F.try_to_timestamp(F.col(name), F.lit("M/d/yyyy")).cast("date")

    def flag(name):
        return F.coalesce(F.upper(F.col(name)) == "TRUE", F.lit(False))

    stamp = F.lit(str(as_of)).cast("timestamp")
    return df.withColumns(
        {
            "Date": day("Date"),
            "Target Close": day("Target Close"),
            "Forecasted Monthly Revenue": F.col("Forecasted Monthly Revenue").try_cast("double"),
            "Weighted Revenue": F.col("Weighted Revenue").try_cast("double"),
            "Closed Opportunity": flag("Closed Opportunity"),
            "Active Opportunity": flag("Active Opportunity"),
            "Latest Status Entry": F.when(flag("Latest Status Entry"), stamp),
        }
    )


def read_json(
    spark: SparkSession, path, schema: StructType | str | None = None, multi_line: bool = False
) -> DataFrame:
    reader = spark.read.option("multiLine", multi_line)
    return (reader.schema(schema) if schema is not None else reader).json(path)


def read_landing(
    spark: SparkSession,
    root: str,
    date: str | None = None,
    schema: StructType | str = RAW_WEATHER,
) -> DataFrame:
    """JSON drops below ``root/<date>/`` or ``root/date=<date>/``, all days or one.

    The form of a file follows from its writer: part files, as ``to_landing`` writes them, hold a
    document per line, all others one document that may span lines.
    """
    days = f"{{{date},date={date}}}" if date else "*"

    def found(names: str, multi_line: bool) -> DataFrame:
        reader = spark.read.schema(schema).option("multiLine", multi_line)
        return reader.option("pathGlobFilter", names).json(f"{root}/{days}")

    others = "{[!p]*,p,p[!a]*,pa,pa[!r]*,par,par[!t]*,part,part[!-]*}.json"
    return found(others, True).unionByName(found("part-*.json", False))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def decode_json(
    messages: DataFrame, schema: StructType | str, value: str = "value", metadata: Iterable[str] = ()
) -> DataFrame:
    """Message bytes or text to typed columns; a message that is not JSON gives NULL columns.

    ``metadata`` names columns of the broker (key, timestamp, offset, ...) to keep, each as
    ``message_<name>``.
    """
    parsed = F.from_json(F.col(value).cast("string"), schema)
    kept = [F.col(name).alias(f"message_{name}") for name in metadata]
    names = [f"message_{name}" for name in metadata]
    return messages.select(*kept, parsed.alias("_message")).select(*names, "_message.*")


def read_event_stream(
    spark: SparkSession,
    schema: StructType | str,
    source: str = "kafka",
    starting: str = "latest",
    options: Mapping[str, str] | None = None,
    metadata: Iterable[str] = (),
) -> DataFrame:
    """JSON messages as a stream of typed rows, with ``metadata`` of the broker where named.

    ``source`` is ``kafka`` (with ``kafka.bootstrap.servers`` and ``subscribe`` among the
    options) or any stream source with a ``value`` column, such as ``text``.
    """
    reader = spark.readStream.format(source).options(**dict(options or {}))
    if source == "kafka":
        reader = reader.option("startingOffsets", starting)
    return decode_json(reader.load(), schema, metadata=metadata)


def read_avro_stream(
    spark: SparkSession, reader_schema: str, options: Mapping[str, str], starting: str = "latest"
) -> DataFrame:
    """Avro messages read under one reader schema; needs the spark-avro and Kafka packages."""
    from pyspark.sql.avro.functions import from_avro

    # A registry puts five bytes (magic byte, schema id) before the record.
    messages = (
        spark.readStream.format("kafka")
        .options(**dict(options))
        .option("startingOffsets", starting)
        .load()
    )
    body = F.expr("substring(value, 6, length(value) - 5)")
    record = from_avro(body, reader_schema, {"mode": "PERMISSIVE"})
    return messages.select(record.alias("_message")).select("_message.*")


def jdbc_partitions(column: str, lower, upper, partitions: int) -> dict[str, str]:
    """Options that split a relational scan into parallel range queries."""
    if partitions < 1:
        raise ValueError("partitions must be positive")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    partition: Mapping[str, str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table)
    return reader.options(**dict(partition or {}), **dict(options or {})).load()


def read_seed(spark: SparkSession, path: str, name: str, schema: StructType | str) -> DataFrame:
    """A CSV kept with the project, also registered under a name for SQL."""
    seed = spark.read.schema(schema).option("header", True).csv(path)
    seed.createOrReplaceTempView(name)
    return seed


def scan_table(
    spark: SparkSession, table: str, columns: list[str], order: list[str], limit: int
) -> DataFrame:
    """The first rows of a table in a total order."""
    return spark.table(table).select(*columns).orderBy(*order).limit(limit)


def literal_rows(spark: SparkSession, rows: Iterable, schema) -> DataFrame:
    return spark.createDataFrame(list(rows), schema)


def register_views(views: Mapping[str, DataFrame]) -> None:
    for name, df in views.items():
        df.createOrReplaceTempView(name)


@contextmanager
def named_views(spark: SparkSession, views: Mapping[str, DataFrame], made: Iterable[str] = ()) -> Iterator[None]:
    """Views for a while: their names, and those in ``made``, afterwards mean what they meant before.

    Rows that were read from a view stay readable, as their plan holds what it stood for."""
    before = {}
    for name in {*views, *made}:
        if spark.catalog.tableExists(name) and spark.catalog.getTable(name).isTemporary:
            before[name] = spark.table(name)
    register_views(views)
    try:
        yield
    finally:
        for name in {*views, *made}:
            spark.catalog.dropTempView(name)
        register_views(before)


def resolve_table(spark: SparkSession, preference: list[str]) -> str:
    """The first table or view of the list that exists."""
    for name in preference:
        if spark.catalog.tableExists(name):
            return name
    raise ValueError(f"none of these tables exists: {', '.join(preference)}")


# Order in which tables answer a question.
DETAIL_TABLES = ["weather_batch", "weather_streaming", "weather_streaming_hourly"]
ANALYTICS_TABLES = ["weather_analytics", "weather_streaming_hourly", "weather_streaming"]
