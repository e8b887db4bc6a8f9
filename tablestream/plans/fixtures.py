"""Views over the given tables, in Spark and in SQL.

Results leave the queries in plain types: dates as ISO text, timestamps without a zone, means
rounded, so that both engines print the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions.columns import json_number
from tablestream.session import use_utc

AS_OF = "2024-01-31"
CITIES = ["click", "error", "purchase", "signup", "view"]


def table(spark: SparkSession, data: str, name: str) -> DataFrame:
    return use_utc(spark).read.parquet(f"{data}/{name}.parquet")


def rounded(df: DataFrame, *names: str) -> DataFrame:
    """Six digits. Rounding to nine first lifts a tie out of the noise of the summation order."""
    return df.withColumns({name: F.round(F.round(name, 9), 6) for name in names})


def text(df: DataFrame, *names: str) -> DataFrame:
    """Dates as ISO text."""
    return df.withColumns({name: F.col(name).cast("string") for name in names})


def plain(df: DataFrame, *names: str) -> DataFrame:
    """Timestamps without a zone."""
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in names})


def readings(spark: SparkSession, data: str) -> DataFrame:
    return reading_columns(table(spark, data, "events"))


def reading_columns(events: DataFrame, ts: str = "measurement_time") -> DataFrame:
    k = json_number(F.col("props"), "$.k")
    return events.select(
        "event_id",
        F.col("event_type").alias("city_name"),
        F.col("ts").alias(ts),
        F.col("value").alias("temperature"),
        k.alias("humidity"),
        (F.col("user_id") % 25).cast("double").alias("wind_speed"),
        (k / 2 + 990).alias("pressure"),
    )


READINGS = """
readings AS (
  SELECT event_id, event_type AS city_name, ts AS measurement_time, value AS temperature,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS humidity,
         CAST(user_id % 25 AS DOUBLE) AS wind_speed,
         990 + CAST(json_extract_string(props, '$.k') AS DOUBLE) / 2 AS pressure
  FROM events)
"""


def hourly(spark: SparkSession, data: str) -> DataFrame:
    return (
        readings(spark, data)
        .groupBy("city_name", F.window("measurement_time", "1 hour"))
        .agg(
            F.avg("temperature").alias("avg_temperature"),
            F.max("temperature").alias("max_temperature"),
            F.min("temperature").alias("min_temperature"),
            F.avg("humidity").alias("avg_humidity"),
            F.avg("pressure").alias("avg_pressure"),
        )
        .withColumns({"window_start": F.col("window.start"), "window_end": F.col("window.end")})
        .drop("window")
    )


HOURLY = (
    READINGS
    + """,
hourly AS (
  SELECT city_name, date_trunc('hour', measurement_time) AS window_start,
         date_trunc('hour', measurement_time) + INTERVAL 1 HOUR AS window_end,
         avg(temperature) AS avg_temperature, max(temperature) AS max_temperature,
         min(temperature) AS min_temperature, avg(humidity) AS avg_humidity,
         avg(pressure) AS avg_pressure
  FROM readings GROUP BY 1, 2, 3)
"""
)


def cents(price: Column) -> Column:
    return F.round(price * 100).cast("long")


def customers(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_name").alias("name"), "c_mktsegment"
    )


def orders(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.to_date("o_orderdate").alias("order_date"),
        cents(F.col("o_totalprice")).alias("total_amount"),
    )


def opportunities(spark: SparkSession, data: str) -> DataFrame:
    named = (
        table(spark, data, "customer")
        .join(table(spark, data, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .join(table(spark, data, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("c_custkey", "c_name", "c_mktsegment", "r_name")
    )
    lead = F.when(F.col("o_orderkey") % 17 != 0, F.col("o_orderkey").cast("string"))
    return (
        table(spark, data, "orders")
        .join(named, F.col("o_custkey") == F.col("c_custkey"))
        .select(
            F.to_date("o_orderdate").alias("Date"),
            F.col("c_name").alias("Salesperson"),
            lead.alias("Lead Name"),
            F.col("c_mktsegment").alias("Segment"),
            F.col("r_name").alias("Region"),
            F.col("o_totalprice").alias("Forecasted Monthly Revenue"),
            F.col("o_orderstatus").alias("Opportunity Stage"),
        )
    )


OPPORTUNITIES = """
opportunities AS (
  SELECT CAST(o_orderdate AS DATE) AS "Date", c_name AS Salesperson,
         CASE WHEN o_orderkey % 17 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS "Lead Name",
         c_mktsegment AS Segment, r_name AS Region,
         o_totalprice AS "Forecasted Monthly Revenue", o_orderstatus AS "Opportunity Stage"
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)
"""


def sales(spark: SparkSession, data: str) -> DataFrame:
    stores = (
        table(spark, data, "supplier")
        .join(table(spark, data, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, data, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
        .select("s_suppkey", F.col("r_name").alias("region"))
    )
    return (
        table(spark, data, "lineitem")
        .join(stores, F.col("l_suppkey") == F.col("s_suppkey"))
        .select(
            F.col("l_partkey").alias("product_id"), F.col("l_quantity").alias("quantity"), "region"
        )
    )


def products(spark: SparkSession, data: str) -> DataFrame:
    return table(spark, data, "part").select(
        F.col("p_partkey").alias("product_id"), F.col("p_name").alias("product_name")
    )


PRODUCT_TOTALS = """
totals AS (
  SELECT r_name AS region, p_name AS product_name, sum(l_quantity) AS total_sold
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
  GROUP BY 1, 2)
"""


def raw_weather(spark: SparkSession, data: str) -> DataFrame:
    """Raw records as JSON text, as they land. Lists hold none, one or two conditions."""
    k = json_number(F.col("props"), "$.k")
    rain = F.struct(F.lit("Rain").alias("main"), F.lit("light rain").alias("description"))
    other = F.struct(F.lit("Clouds").alias("main"), F.col("event_type").alias("description"))
    nothing = F.array().cast("array<struct<main: string, description: string>>")
    listed = (
        F.when(F.col("user_id") % 3 == 0, nothing)
        .when(F.col("user_id") % 3 == 1, F.array(other))
        .otherwise(F.array(rain, other))
    )
    sunrise = F.unix_timestamp(F.date_trunc("day", "ts")) + 21600
    record = F.struct(
        F.struct(F.col("user_id").alias("lon"), (F.col("user_id") / 2).alias("lat")).alias("coord"),
        listed.alias("weather"),
        F.struct(
            F.col("value").alias("temp"),
            (F.col("value") - 1.5).alias("feels_like"),
            (k / 2 + 990).alias("pressure"),
            k.alias("humidity"),
        ).alias("main"),
        F.struct((F.col("user_id") % 25).alias("speed"), F.col("user_id").alias("deg")).alias("wind"),
        F.struct(k.alias("all")).alias("clouds"),
        F.unix_timestamp("ts").alias("dt"),
        F.struct(
            sunrise.alias("sunrise"),
            (sunrise + 39600 + F.col("user_id") % 3 * 1800).alias("sunset"),
        ).alias("sys"),
        F.col("event_id").alias("id"),
        F.upper("event_type").alias("name"),
        F.col("event_type").alias("city_name"),
    )
    return table(spark, data, "events").select(F.to_json(record).alias("value"))


def clicks(spark: SparkSession, data: str) -> DataFrame:
    events = table(spark, data, "events")
    country = F.when(F.col("event_id") % 11 != 0, F.concat(F.lit("C"), F.col("user_id") % 7))
    return events.select(
        F.col("event_id").cast("string").alias("event_id"),
        F.col("ts").cast("string").alias("timestamp"),
        "event_type",
        country.alias("country"),
        F.round(F.col("value") * 100).cast("int").alias("duration_ms"),
    )


def device(event_id: Column) -> Column:
    return F.when(event_id % 4 == 1, "mobile").otherwise("desktop")
