"""Loads into catalog tables, seeds, literal rows and small scans.

Each query has a database of its own below the shared folder, so that it meets no table of anybody
else under the names that the jobs use.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream import weather
from tablestream.operators import aggregates, shape
from tablestream.plans.fixtures import READINGS, plain, raw_weather, readings, rounded, table, text
from tablestream.plans.registry import query
from tablestream.session import run_dir
from tablestream.sources import readers, writers

MOMENT = "2024-02-01 06:30:00"


@contextmanager
def _own_database(spark: SparkSession) -> Iterator[None]:
    name, before = f"run_{uuid.uuid4().hex}", spark.catalog.currentDatabase()
    spark.sql(f"CREATE DATABASE {name} LOCATION '{run_dir(spark, 'database')}'")
    spark.catalog.setCurrentDatabase(name)
    try:
        yield
    finally:
        spark.catalog.setCurrentDatabase(before)


@query("""
SELECT event_id, event_type AS city_name, value AS temp, CAST(user_id % 25 AS BIGINT) AS speed,
       CAST(user_id % 3 AS BIGINT) AS conditions
FROM events
""")
def json_inferred(spark: SparkSession, data: str) -> DataFrame:
    """Nested JSON whose schema is found in the files."""
    path = run_dir(spark, "raw-json")
    raw_weather(spark, data).write.text(path)
    rows = readers.read_json(spark, path)
    return rows.select(
        F.col("id").alias("event_id"), "city_name", "main.temp", "wind.speed",
        F.size("weather").cast("long").alias("conditions"),
    )


@query("""
SELECT n_name AS nation, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
GROUP BY 1
""")
def seeded_names(spark: SparkSession, data: str) -> DataFrame:
    path = run_dir(spark, "seed")
    nations = table(spark, data, "nation").select("n_nationkey", "n_name")
    writers.write_csv(nations.coalesce(1), path)
    with readers.named_views(spark, {}, ["nation_seed"]):
        readers.read_seed(spark, path, "nation_seed", nations.schema)
        return spark.sql(
            """SELECT n_name AS nation, count(*) AS customers
               FROM {customers} JOIN nation_seed ON c_nationkey = n_nationkey GROUP BY n_name""",
            customers=table(spark, data, "customer"),
        )


@query("""
SELECT c_custkey, c_name, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 25
""")
def table_scan(spark: SparkSession, data: str) -> DataFrame:
    """The first rows of a stored table, of three of its columns."""
    with _own_database(spark):
        writers.append_table(table(spark, data, "customer"), "customers")
        columns = ["c_custkey", "c_name", "c_acctbal"]
        return readers.scan_table(spark, "customers", columns, [F.desc("c_acctbal"), "c_custkey"], 25)


@query("""
SELECT label, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) AS revenue
FROM orders JOIN (VALUES ('O', 'open'), ('F', 'filled'), ('X', 'never')) AS named(status, label)
  ON o_orderstatus = status GROUP BY 1
""")
def literal_labels(spark: SparkSession, data: str) -> DataFrame:
    named = readers.literal_rows(spark, [("O", "open"), ("F", "filled"), ("X", "never")], "status string, label string")
    orders = table(spark, data, "orders")
    by_status = orders.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum(F.col("o_totalprice").cast("decimal(18,2)")).cast("double").alias("revenue"),
    )
    return by_status.join(named, F.col("o_orderstatus") == F.col("status")).select("label", "orders", "revenue")


@query("SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders")
def table_append(spark: SparkSession, data: str) -> DataFrame:
    """Two appends; the second has its columns in another order."""
    rows = table(spark, data, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    with _own_database(spark):
        writers.append_table(rows.filter("o_orderkey % 3 = 0"), "orders_loaded")
        again = rows.filter("o_orderkey % 3 <> 0").select("o_totalprice", "o_orderkey", "o_orderstatus")
        writers.append_table(again, "orders_loaded")
        return spark.table("orders_loaded")


@query("""
WITH loads AS (
  SELECT count(*) FILTER (WHERE o_orderkey % 2 = 0) AS first,
         count(*) FILTER (WHERE o_orderkey % 2 = 1) AS second,
         count(*) FILTER (WHERE o_orderkey % 5 = 0) AS third FROM orders)
SELECT o_orderkey, o_totalprice, first AS truncated, second AS appended, third AS reloaded
FROM orders, loads WHERE o_orderkey % 5 = 0
""")
def table_dispositions(spark: SparkSession, data: str) -> DataFrame:
    """EMPTY into a new table, APPEND, then TRUNCATE; each load returns its rows."""
    rows = table(spark, data, "orders").select("o_orderkey", "o_totalprice")
    with _own_database(spark):
        names = {"ORDERS": "orders_loaded"}
        first = writers.load_table(rows.filter("o_orderkey % 2 = 0"), names, "ORDERS", "EMPTY")
        second = writers.load_table(rows.filter("o_orderkey % 2 = 1"), names, "ORDERS")
        third = writers.load_table(rows.filter("o_orderkey % 5 = 0"), names, "ORDERS", "TRUNCATE")
        return spark.table("orders_loaded").withColumns(
            {"truncated": F.lit(first).cast("long"), "appended": F.lit(second).cast("long"), "reloaded": F.lit(third).cast("long")}
        )


@query(f"""
WITH {READINGS}
SELECT event_id, city_name, strftime(measurement_time, '%Y-%m-%d') AS date FROM readings
WHERE CAST(measurement_time AS DATE) >= DATE '2024-01-30' - INTERVAL 20 DAY
""")
def expired_partitions(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data).select("event_id", "city_name", F.to_date("measurement_time").alias("date"))
    with _own_database(spark):
        writers.create_layout(rows, "daily", ["date"], ["city_name"])
        writers.expire_partitions(spark, "daily", "date", 20, date(2024, 1, 30))
        return text(spark.table("daily"), "date")


@query("""
SELECT event_id, event_type, CASE WHEN event_id % 2 = 1 THEN value END AS value,
       CASE WHEN event_id % 2 = 1 THEN 'v2' END AS schema_version
FROM events
""")
def table_grows(spark: SparkSession, data: str) -> DataFrame:
    """A table that gets two columns at its end between two loads."""
    rows = table(spark, data, "events")
    with _own_database(spark):
        writers.ensure_table(spark, "messages", "event_id long, event_type string")
        writers.append_table(rows.filter("event_id % 2 = 0").select("event_id", "event_type"), "messages")
        wider = "event_id long, event_type string, value double, schema_version string"
        writers.ensure_table(spark, "messages", wider)
        spark.catalog.refreshTable("messages")
        new = rows.filter("event_id % 2 = 1").select("event_id", "event_type", "value", F.lit("v2").alias("schema_version"))
        writers.append_table(new, "messages")
        return spark.table("messages")


@query("""
SELECT c_custkey AS customer_id, count(o_orderkey) AS orders,
       CAST(coalesce(sum(CAST(o_totalprice AS DECIMAL(18,2))), 0) AS DOUBLE) AS spent
FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1
""")
def saved_model(spark: SparkSession, data: str) -> DataFrame:
    orders = table(spark, data, "orders").groupBy("o_custkey").agg(
        F.count(F.lit(1)).alias("orders"), F.sum(F.col("o_totalprice").cast("decimal(18,2)")).alias("spent")
    )
    model = table(spark, data, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left").select(
        F.col("c_custkey").alias("customer_id"), F.coalesce("orders", F.lit(0)).alias("orders"),
        F.coalesce("spent", F.lit(0)).cast("double").alias("spent"),
    )
    with _own_database(spark):
        writers.save_model(model.limit(0), "customer_orders")
        writers.save_model(model, "customer_orders")  # a model is replaced when it is built again
        return spark.table("customer_orders")


@query(f"""
SELECT c_custkey AS id, c_name AS name, lower(c_name) AS username, c_name || '@example.com' AS email,
       c_mktsegment || ' street' AS street, 'Apt. ' || (c_custkey % 90) AS suite, n_name AS city,
       CAST(c_nationkey AS VARCHAR) AS zipcode, c_mktsegment AS company_name,
       'more ' || c_mktsegment AS company_catchphrase, r_name AS company_bs, '{MOMENT}' AS processed_at
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
""")
def flat_users(spark: SparkSession, data: str) -> DataFrame:
    nations = table(spark, data, "nation").join(
        table(spark, data, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    people = table(spark, data, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    segment = F.col("c_mktsegment")
    users = people.select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.lower("c_name").alias("username"),
        F.concat("c_name", F.lit("@example.com")).alias("email"),
        F.struct(
            F.concat(segment, F.lit(" street")).alias("street"),
            F.concat(F.lit("Apt. "), F.col("c_custkey") % 90).alias("suite"),
            F.col("n_name").alias("city"), F.col("c_nationkey").cast("string").alias("zipcode"),
        ).alias("address"),
        F.struct(
            segment.alias("name"), F.concat(F.lit("more "), segment).alias("catchPhrase"), F.col("r_name").alias("bs")
        ).alias("company"),
    )
    return shape.flatten_user(users, MOMENT)


@query(f"""
SELECT event_id, TIMESTAMP '{MOMENT}' AS processing_time, '{MOMENT[:10]}' AS processing_date, 'run-7' AS run_id
FROM events
""")
def stamped_rows(spark: SparkSession, data: str) -> DataFrame:
    stamped = shape.stamp_lineage(table(spark, data, "events").select("event_id"), MOMENT, "run-7")
    return text(plain(stamped, "processing_time"), "processing_date")


@query("SELECT event_id, 'Processed: ' || event_type AS value FROM events")
def processed_texts(spark: SparkSession, data: str) -> DataFrame:
    rows = table(spark, data, "events")
    return rows.select("event_id", shape.processed_text(F.col("event_type")).alias("value"))


@query("SELECT count(*) AS rows FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-12'")
def rows_of_partition(spark: SparkSession, data: str) -> DataFrame:
    """The rows of one day of a table partitioned by day: only its partition is read."""
    rows = readings(spark, data).select("event_id", F.to_date("measurement_time").alias("date"))
    with _own_database(spark):
        writers.create_layout(rows, "daily", ["date"], [])
        return aggregates.partition_rows(spark.table("daily"), "date", "2024-01-12")


@query(f"""
WITH {READINGS},
days AS (
  SELECT *, CAST(measurement_time AS DATE) AS d FROM readings
  WHERE CAST(measurement_time AS DATE) IN (DATE '2024-01-12', DATE '2024-01-13')),
long AS (
  SELECT city_name, d, 'temperature' AS metric_type, temperature AS v FROM days
  UNION ALL SELECT city_name, d, 'humidity', humidity FROM days
  UNION ALL SELECT city_name, d, 'pressure', pressure FROM days
  UNION ALL SELECT city_name, d, 'wind_speed', wind_speed FROM days)
SELECT city_name, strftime(d, '%Y-%m-%d') AS date, metric_type, round(round(avg(v), 9), 6) AS avg_value,
       min(v) AS min_value, max(v) AS max_value, round(round(stddev_samp(v), 9), 6) AS std_dev
FROM long GROUP BY 1, 2, 3
""")
def inserted_statistics(spark: SparkSession, data: str) -> DataFrame:
    """The statistics of two days inserted into the analytics table, one of them twice."""
    batch = readings(spark, data).withColumn("processing_date", F.to_date("measurement_time"))
    with _own_database(spark):
        names = {"BATCH": weather.BATCH}
        writers.load_table(batch, names, "BATCH", partition=["processing_date"], cluster=["city_name"])
        for day in (12, 13, 12):
            weather.generate_analytics(spark, date(2024, 1, day), MOMENT)
        rows = spark.table(weather.ANALYTICS).drop("processing_time")
    return text(rounded(rows, "avg_value", "std_dev"), "date")
