"""Round trips through files: what is written reads back the same."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, types
from pyspark.sql import functions as F

from tablestream.functions import resolution, variants
from tablestream.operators import daily, quality
from tablestream.plans.fixtures import READINGS, plain, readings, rounded, table
from tablestream.plans.registry import query
from tablestream.session import run_dir
from tablestream.sources import ledger, readers, writers


@query("SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def roundtrip_csv(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "csv")
    customers = table(spark, data, "customer")
    writers.write_csv(customers, path)
    return readers.read_csv(spark, path, customers.schema)


@query("""
SELECT c_mktsegment, count(*) AS customers,
       CAST(sum(CAST(c_acctbal AS DECIMAL(18,2))) AS DOUBLE) AS balance
FROM customer GROUP BY 1
""")
def roundtrip_csv_text(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "csv-text")
    writers.append_files(table(spark, data, "customer"), path)
    rows = readers.with_types(
        readers.read_csv_text(spark, path), {"c_acctbal": "decimal(18,2)"}
    )
    return rows.groupBy("c_mktsegment").agg(
        F.count(F.lit(1)).alias("customers"), F.sum("c_acctbal").cast("double").alias("balance")
    )


@query("""
SELECT event_id, event_type, value, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       strftime(ts, '%Y-%m-%d') AS date FROM events
""")
def roundtrip_landing(spark: SparkSession, data: str) -> DataFrame:
    root = run_dir(spark, "landing")
    events = table(spark, data, "events")
    dated = events.withColumn("date", F.to_date("ts").cast("string"))
    writers.layout(dated.drop("ts"), ["date"], []).write.partitionBy("date").json(root)
    schema = "event_id long, event_type string, value double, props string, date string"
    rows = readers.read_json(spark, root, schema)
    k = F.get_json_object("props", "$.k").cast("long")
    return rows.select("event_id", "event_type", "value", k.alias("k"), "date")


@query("""
SELECT CAST(year(o_orderdate) AS INTEGER) AS year, o_orderkey,
       CASE WHEN year(o_orderdate) = 1997 THEN o_totalprice * 2 ELSE o_totalprice END
         AS o_totalprice
FROM orders
""")
def partition_reload(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "reload")
    orders = table(spark, data, "orders").select(
        F.year("o_orderdate").alias("year"), "o_orderkey", "o_totalprice"
    )
    writers.write_partitions(orders, path, ["year"], ["o_orderkey"])
    again = orders.filter("year = 1997").withColumn("o_totalprice", F.col("o_totalprice") * 2)
    writers.write_partitions(again, path, ["year"], ["o_orderkey"])
    return readers.read_parquet(spark, path)


@query("SELECT event_id, ts, user_id, event_type, value FROM events")
def roundtrip_parquet(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "parquet")
    events = table(spark, data, "events").drop("props")
    writers.write_parquet(events, path)
    return plain(readers.read_parquet(spark, path), "ts")


@query("""
SELECT event_id, event_type, value, user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10'
""")
def landing_day(spark: SparkSession, data: str) -> DataFrame:
    root = run_dir(spark, "landing-day")
    dated = table(spark, data, "events").withColumn("date", F.to_date("ts").cast("string"))
    writers.layout(dated.drop("ts", "props"), ["date"], []).write.partitionBy("date").json(root)
    schema = "event_id long, event_type string, value double, user_id long"
    rows = readers.read_landing(spark, root, "2024-01-10", schema)
    return rows.select("event_id", "event_type", "value", "user_id")


@query(f"""
WITH {READINGS},
long AS (
  SELECT city_name, 'temperature' AS field, temperature AS v, CAST(measurement_time AS DATE) AS d FROM readings
  UNION ALL SELECT city_name, 'humidity', humidity, CAST(measurement_time AS DATE) FROM readings)
SELECT city_name, field, count(*) AS total, count(*) - count(v) AS null_count,
       count(*) FILTER (WHERE field = 'humidity' AND (v < 0 OR v > 100)
                        OR field = 'temperature' AND (v < -50 OR v > 60)) AS out_of_range,
       min(v) AS min_value, max(v) AS max_value, round(round(avg(v), 9), 6) AS avg_value,
       round(round(stddev_samp(v), 9), 6) AS std_dev
FROM long WHERE d BETWEEN DATE '2024-01-05' AND DATE '2024-01-24' GROUP BY 1, 2
""")
def daily_state_range(spark: SparkSession, data: str) -> DataFrame:
    """A range of days from the states, after late readings: every fifth reading of even days lands
    when the states of all days are written already, and only those days are written again."""
    path = run_dir(spark, "states")
    rows = readings(spark, data)
    moment, fields = "measurement_time", ["temperature", "humidity"]
    late = (F.col("event_id") % 5 == 0) & (F.dayofmonth(moment) % 2 == 0)
    ranges = {name: quality.RANGES[name] for name in fields}
    daily.refresh(rows.filter(~late), path, ["city_name"], moment, fields, ranges=ranges)
    daily.refresh(rows, path, ["city_name"], moment, fields, daily.days_of(rows.filter(late), moment), ranges)
    found = daily.over_range(
        daily.read_states(spark, path), ["city_name", "field"], date(2024, 1, 5), date(2024, 1, 24)
    )
    exact = ["total", "null_count", "out_of_range", "min_value", "max_value", "avg_value", "std_dev"]
    return rounded(found.select("city_name", "field", *exact), "avg_value", "std_dev")


@query(f"""
WITH {READINGS}
SELECT 'temperature' AS field, count(*) AS total, count(*) - count(temperature) AS null_count,
       round((count(*) - count(temperature)) * 100.0 / count(*), 6) AS null_percentage,
       true AS quantiles_hold, true AS distinct_holds
FROM readings
""")
def daily_state_profile(spark: SparkSession, data: str) -> DataFrame:
    """The profile from the states; the sketches are held against the exact ranks and values."""
    path = run_dir(spark, "profile")
    rows = readings(spark, data).select("city_name", "measurement_time", "temperature")
    daily.refresh(rows, path, ["city_name"], "measurement_time", ["temperature"])
    found = daily.state_profile(daily.read_states(spark, path))
    shares = {f"q{round(100 * q):02d}": q for q in daily.QUANTILES}
    value, row = F.col("temperature"), found.first()  # one row a field
    below = [F.avg((value <= row[name]).cast("double")).alias(f"{name}_to") for name in shares]
    under = [F.avg((value < row[name]).cast("double")).alias(f"{name}_from") for name in shares]
    exact = rows.agg(F.countDistinct(value).alias("exact"), *below, *under)
    holds = F.lit(True)
    for name, share in shares.items():
        holds = holds & (F.col(f"{name}_from") - 0.03 <= share) & (F.col(f"{name}_to") + 0.03 >= share)
    near = F.abs(F.lit(row["distinct_values"]) - F.col("exact")) <= 2 + 0.06 * F.col("exact")
    return exact.select(
        F.lit(row["field"]).alias("field"), F.lit(row["total"]).cast("long").alias("total"),
        F.lit(row["null_count"]).cast("long").alias("null_count"),
        F.round(F.lit(row["null_percentage"]), 6).alias("null_percentage"),
        holds.alias("quantiles_hold"), near.alias("distinct_holds"),
    )


@query("SELECT event_id, event_type, value, user_id FROM events")
def landing_ledger(spark: SparkSession, data: str) -> DataFrame:
    """Two loads with files added between; the first is repeated, and one that was interrupted has
    left rows behind."""
    root, path = run_dir(spark, "ledger-landing"), run_dir(spark, "ledger-table")
    columns = ["event_id", "event_type", "value", "user_id"]
    events = table(spark, data, "events").withColumn("date", F.to_date("ts"))
    schema = "event_id long, event_type string, value double, user_id long"

    def land(rows: DataFrame) -> None:
        writers.layout(rows.select(*columns, "date"), ["date"], []).write.mode("append").partitionBy("date").json(root)

    def load() -> list[int]:
        return ledger.load_pending(spark, root, path, lambda files: spark.read.schema(schema).json(files), "*.json")

    land(events.filter("event_id % 3 != 0"))
    load()
    load()
    land(events.filter("event_id % 3 = 0"))
    # As if the next load had stopped before its page.
    events.filter("event_id % 3 = 0").select(*columns).limit(10).write.parquet(f"{path}/rows/load=2")
    load()
    return ledger.read_loaded(spark, path).select(columns)


@query("""
SELECT count(*) AS lines, CAST(sum(l_quantity) AS BIGINT) AS quantity, min(l_orderkey) AS first_order
FROM lineitem WHERE l_partkey BETWEEN 5 AND 12
""")
def interleaved_read(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "interleaved")
    lines = table(spark, data, "lineitem").select("l_orderkey", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate")
    writers.write_parquet(writers.interleaved_layout(lines, ["l_shipdate", "l_partkey"], 16), path)
    return readers.read_parquet(spark, path).filter("l_partkey BETWEEN 5 AND 12").agg(
        F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").cast("long").alias("quantity"),
        F.min("l_orderkey").alias("first_order"),
    )


@query("""
SELECT event_id, CAST(user_id AS DOUBLE) AS account, event_type AS kind,
       CAST(round(value * 100) AS BIGINT) AS cents, 'EUR' AS currency, NULL::VARCHAR AS note,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, 'unknown' AS origin
FROM events
""")
def schema_resolution(spark: SparkSession, data: str) -> DataFrame:
    """Rows stored under an old schema, read under a new one: names changed, types wider, fields new."""
    path = run_dir(spark, "old-schema")
    k = F.get_json_object("props", "$.k").cast("int")
    table(spark, data, "events").select(
        "event_id", F.col("user_id").cast("int").alias("user_id"), "event_type",
        F.round(F.col("value") * 100).cast("long").alias("amount"), F.struct(k.alias("k")).alias("props"),
    ).write.parquet(path)
    f, t = resolution.field, types
    reader = t.StructType([
        f("event_id", t.LongType()), f("account", t.DoubleType(), aliases=("customer", "user_id")),
        f("kind", t.StringType(), aliases=("event_type",)), f("cents", t.LongType(), aliases=("amount",)),
        f("currency", t.StringType(), default="EUR"), f("note", t.StringType(), default=None),
        f("props", t.StructType([f("k", t.LongType()), f("origin", t.StringType(), default="unknown")])),
    ])
    rows = resolution.resolve(readers.read_parquet(spark, path), reader)
    return rows.select("*", "props.*").drop("props")


@query("""
SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
       CAST(json_extract_string(props, '$.k') AS DOUBLE) / 2 AS half, event_type AS kind,
       user_id % 3 AS conditions, CASE WHEN user_id % 3 > 0 THEN event_type END AS first_condition
FROM events
""")
def json_variant(spark: SparkSession, data: str) -> DataFrame:
    """Several paths of a nested JSON text that is parsed once a row, after a round trip as VARIANT."""
    path = run_dir(spark, "variant")
    raw = table(spark, data, "events").withColumn("k", F.get_json_object("props", "$.k").cast("long"))
    listed = F.transform(
        F.slice(F.array("event_type", "event_type"), 1, (F.col("user_id") % 3).cast("int")),
        lambda x: F.struct(x.alias("main")),
    )
    record = F.struct(
        "event_id", F.struct("k", (F.col("k") / 2).alias("half")).alias("main"), listed.alias("weather"),
        F.col("event_type").alias("name"),
    )
    text = raw.select(F.to_json(record).alias("value"))
    text.select(variants.as_variant(F.col("value")).alias("record")).write.parquet(path)
    paths = {
        "event_id": ("$.event_id", "long"), "k": ("$.main.k", "long"), "half": ("$.main.half", "double"),
        "kind": ("$.name", "string"), "listed": ("$.weather", "array<struct<main: string>>"),
        "first_condition": ("$.weather[0].main", "string"),
    }
    found = readers.read_parquet(spark, path).select(*variants.variant_values("record", paths))
    return found.withColumn("conditions", F.size("listed").cast("long")).drop("listed")
