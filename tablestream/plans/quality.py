"""Key checks, data tests and quality reports."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.operators import joins, quality
from tablestream.plans.fixtures import CITIES, HOURLY, READINGS, hourly, readings, rounded, table
from tablestream.plans.registry import query

FIELDS = ["temperature", "humidity", "pressure"]


@query("""
SELECT c_custkey AS customer_id FROM customer
WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
""")
def missing_keys(spark: SparkSession, data: str) -> DataFrame:
    expected = table(spark, data, "customer").withColumnRenamed("c_custkey", "customer_id")
    observed = table(spark, data, "orders").filter("o_orderstatus = 'P'")
    observed = observed.withColumnRenamed("o_custkey", "customer_id")
    return joins.missing_keys(expected, observed, "customer_id")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice FROM lineitem
WHERE l_orderkey NOT IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')
""")
def orphans(spark: SparkSession, data: str) -> DataFrame:
    lines = table(spark, data, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice"
    )
    parents = table(spark, data, "orders").filter("o_orderstatus <> 'P'")
    return joins.orphans(lines, parents, "l_orderkey", "o_orderkey")


@query("""
SELECT o_orderkey, o_totalprice, 'old' AS state FROM orders WHERE o_orderkey % 2 = 0
UNION ALL
SELECT o_orderkey, o_totalprice * 2, 'new' FROM orders
WHERE o_orderkey % 3 = 0 AND o_orderkey % 2 <> 0
""")
def insert_if_absent(spark: SparkSession, data: str) -> DataFrame:
    rows = table(spark, data, "orders").select("o_orderkey", "o_totalprice")
    old = rows.filter("o_orderkey % 2 = 0").withColumn("state", F.lit("old"))
    new = rows.filter("o_orderkey % 3 = 0").select(
        "o_orderkey", (F.col("o_totalprice") * 2).alias("o_totalprice"), F.lit("new").alias("state")
    )
    return joins.insert_if_absent(old, new, "o_orderkey")


def _with_gaps(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data)
    gap = {"temperature": 17, "humidity": 12, "pressure": 1_000_003}
    return rows.withColumns(
        {name: F.when(F.col("event_id") % n != 0, F.col(name)) for name, n in gap.items()}
    )


GAPS = f"""
{READINGS},
gaps AS (
  SELECT event_id, city_name, measurement_time,
         CASE WHEN event_id % 17 <> 0 THEN temperature END AS temperature,
         CASE WHEN event_id % 12 <> 0 THEN humidity END AS humidity,
         CASE WHEN event_id % 1000003 <> 0 THEN pressure END AS pressure
  FROM readings)
"""


@query(f"WITH {GAPS}" + " UNION ALL ".join(
    f"""
SELECT '{f}' AS field, count(*) AS total, count(*) - count({f}) AS null_count,
       count({f}) AS non_null, round(round(100.0 * (count(*) - count({f})) / count(*), 9), 6)
         AS null_percentage
FROM gaps
""" for f in FIELDS))
def null_profile(spark: SparkSession, data: str) -> DataFrame:
    return rounded(quality.null_profile(_with_gaps(spark, data), FIELDS), "null_percentage")


@query(f"WITH {GAPS}" + " UNION ALL ".join(
    f"""
SELECT '{f}' AS field, count({f}) AS total,
       count(*) FILTER (WHERE {f} < {low} OR {f} > {high}) AS out_of_range,
       round(round(100.0 * count(*) FILTER (WHERE {f} < {low} OR {f} > {high}) / count({f}), 9), 6)
         AS out_of_range_percentage,
       min({f}) AS min_value, max({f}) AS max_value, round(round(avg({f}), 9), 6) AS avg_value,
       round(round(stddev_samp({f}), 9), 6) AS std_dev
FROM gaps
""" for f, (low, high) in quality.RANGES.items() if f in FIELDS))
def range_profile(spark: SparkSession, data: str) -> DataFrame:
    ranges = {f: quality.RANGES[f] for f in FIELDS}
    rows = quality.range_profile(_with_gaps(spark, data), ranges)
    return rounded(rows, "out_of_range_percentage", "avg_value", "std_dev")


def _status_sql(name: str, rows: str, day: str, prefix: str) -> str:
    worst = []
    for f in FIELDS:
        column = prefix + f
        low, high = quality.RANGES[f]
        worst.append(f"100.0 * (count(*) - count({column})) / count(*) AS n_{f}")
        worst.append(
            f"100.0 * count(*) FILTER (WHERE {column} < {low} OR {column} > {high})"
            f" / count({column}) AS o_{f}"
        )
    nulls = "greatest(" + ", ".join(f"n_{f}" for f in FIELDS) + ")"
    out = "greatest(" + ", ".join(f"o_{f}" for f in FIELDS) + ")"
    return f"""
    SELECT '{name}' AS "table", missing,
           greatest(CASE WHEN missing > 0.1 * wanted THEN 2 WHEN missing > 0 THEN 1 ELSE 0 END,
                    CASE WHEN {nulls} > 10 THEN 2 WHEN {nulls} > 5 THEN 1 ELSE 0 END,
                    CASE WHEN {out} > 5 THEN 2 WHEN {out} > 1 THEN 1 ELSE 0 END) AS severity
    FROM (SELECT {", ".join(worst)} FROM {rows}),
         (SELECT wanted, wanted - seen AS missing FROM
            (SELECT 7 * 5 AS wanted),
            (SELECT count(*) AS seen FROM (
               SELECT DISTINCT city_name, CAST({day} AS DATE) FROM {rows}
               WHERE {day} >= DATE '2024-01-24' AND {day} < DATE '2024-01-31')))
    """


@query(f"""
WITH {HOURLY}, gaps AS (
  SELECT event_id, city_name, measurement_time, least(temperature, 60) AS temperature,
         CASE WHEN event_id % 12 <> 0 THEN humidity END AS humidity, pressure
  FROM readings),
checked AS (
  {_status_sql("weather_batch", "gaps", "measurement_time", "")}
  UNION ALL {_status_sql("weather_streaming_hourly", "hourly", "window_start", "avg_")}),
listed AS (
  SELECT "table", missing, severity, CASE severity WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARNING'
         ELSE 'FAIL' END AS status FROM checked
  UNION ALL SELECT 'weather_analytics', NULL, 0, 'NOT_FOUND')
SELECT "table", missing, status FROM listed
UNION ALL
SELECT 'overall', NULL, CASE max(severity) WHEN 0 THEN 'PASS' WHEN 1 THEN 'WARNING' ELSE 'FAIL' END
FROM listed
""")
def quality_status(spark: SparkSession, data: str) -> DataFrame:
    rows = readings(spark, data)
    batch = rows.withColumns(
        {
            "temperature": F.least("temperature", F.lit(60.0)),
            "humidity": F.when(F.col("event_id") % 12 != 0, F.col("humidity")),
        }
    )
    tables = {
        "weather_batch": quality.Checked(batch, F.to_date("measurement_time"), FIELDS),
        "weather_streaming_hourly": quality.Checked(
            hourly(spark, data), F.to_date("window_start"), [f"avg_{f}" for f in FIELDS]
        ),
        "weather_analytics": quality.Checked(None, F.col("date"), []),
    }
    expected = spark.range(1).select(
        F.explode(F.array(*[F.lit(city) for city in CITIES])).alias("city_name")
    )
    return quality.quality_report(spark, tables, expected, "city_name", date(2024, 1, 30), 7)


@query("""
SELECT 'line_order_not_null' AS test, count(*) FILTER (WHERE l_orderkey IS NULL) AS failures
FROM lineitem
UNION ALL
SELECT 'line_flag_accepted', count(*) FILTER (WHERE l_returnflag NOT IN ('A', 'N')) FROM lineitem
UNION ALL
SELECT 'line_discount_in_range', count(*) FILTER (WHERE l_discount > 0.08) FROM lineitem
UNION ALL
SELECT 'line_unique', count(*) FROM (SELECT 1 FROM lineitem GROUP BY l_orderkey, l_linenumber
                                     HAVING count(*) > 1)
UNION ALL
SELECT 'order_unique', count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)
UNION ALL
SELECT 'order_status_accepted', count(*) FILTER (WHERE o_orderstatus NOT IN ('O', 'F'))
FROM orders
""")
def data_tests(spark: SparkSession, data: str) -> DataFrame:
    lines, orders = table(spark, data, "lineitem"), table(spark, data, "orders")
    on_lines = {
        "line_order_not_null": F.col("l_orderkey").isNull(),
        "line_flag_accepted": ~F.col("l_returnflag").isin(["A", "N"]),
        "line_discount_in_range": F.col("l_discount") > 0.08,
    }
    on_orders = {"order_status_accepted": ~F.col("o_orderstatus").isin(["O", "F"])}
    return (
        quality.column_tests(lines, on_lines)
        .unionByName(quality.unique_test(lines, ["l_orderkey", "l_linenumber"], "line_unique"))
        .unionByName(quality.unique_test(orders, ["o_orderkey"], "order_unique"))
        .unionByName(quality.column_tests(orders, on_orders))
    )


@query("""
SELECT event_id, CASE WHEN event_id % 17 = 0 OR event_id % 23 = 0 OR event_id % 29 = 0 THEN NULL
                 ELSE CAST(json_extract_string(props, '$.k') AS DOUBLE) END AS k,
       CASE WHEN event_id % 17 = 0 THEN '{"k": ' WHEN event_id % 23 = 0 THEN 'not json'
            WHEN event_id % 29 = 0 THEN '{"k": "high"}' END AS dead_letter
FROM events
""")
def dead_letter_split(spark: SparkSession, data: str) -> DataFrame:
    number = F.col("event_id")
    broken = (
        F.when(number % 17 == 0, '{"k": ')
        .when(number % 23 == 0, "not json")
        .when(number % 29 == 0, '{"k": "high"}')
        .otherwise(F.col("props"))
    )
    messages = table(spark, data, "events").select("event_id", broken.alias("value"))
    return quality.decode_or_keep(messages, "k double")
