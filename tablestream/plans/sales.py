"""Sales, orders and opportunities."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablestream.functions import columns
from tablestream.functions.predicates import above, date_range
from tablestream.operators import aggregates, joins, ranking, series
from tablestream.plans.fixtures import (
    OPPORTUNITIES,
    PRODUCT_TOTALS,
    customers,
    opportunities,
    orders,
    products,
    rounded,
    sales,
    table,
    text,
)
from tablestream.plans.registry import query
from tablestream.sources.readers import ingest_opportunities as parse_opportunities

START, END = "1996-01-01", "1999-12-31"


@query("""
SELECT c_mktsegment AS department, round(round(avg(c_acctbal), 9), 6) AS average_salary
FROM customer WHERE c_acctbal > 25 GROUP BY 1
""")
def filter_group_avg(spark: SparkSession, data: str) -> DataFrame:
    rows = above(table(spark, data, "customer"), "c_acctbal", 25.0)
    averages = aggregates.group_average(rows, "c_mktsegment", "c_acctbal", "average_salary")
    return rounded(averages.withColumnRenamed("c_mktsegment", "department"), "average_salary")


@query("""
SELECT coalesce(CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE), 0) AS total_amount
FROM orders WHERE o_totalprice > 60000
""")
def filtered_total(spark: SparkSession, data: str) -> DataFrame:
    orders_table = table(spark, data, "orders")
    return aggregates.filtered_total(orders_table, "o_totalprice", 60000.0, "total_amount")


@query(f"WITH {PRODUCT_TOTALS} SELECT * FROM totals")
def sales_by_region_product(spark: SparkSession, data: str) -> DataFrame:
    totals = joins.quantity_by_region_product(sales(spark, data), products(spark, data))
    return totals.orderBy("region", F.desc("total_sold"), "product_name")


@query(f"""
WITH {PRODUCT_TOTALS}
SELECT region, product_name, total_sold,
       CAST(row_number() OVER (PARTITION BY region ORDER BY total_sold DESC, product_name)
            AS INTEGER) AS rank
FROM totals QUALIFY rank <= 10
""")
def top_products_per_region(spark: SparkSession, data: str) -> DataFrame:
    totals = joins.quantity_by_region_product(sales(spark, data), products(spark, data))
    order = [F.desc("total_sold"), F.asc("product_name")]
    return ranking.top_n_per_group(totals, ["region"], order, 10)


@query("""
SELECT c_custkey AS customer_id, c_name AS customer_name, count(o_orderkey) AS total_orders,
       CAST(sum(CAST(round(o_totalprice * 100) AS BIGINT)) AS BIGINT) AS total_spent,
       round(round(avg(CAST(round(o_totalprice * 100) AS BIGINT)), 9), 6) AS avg_order_value
FROM customer JOIN orders ON c_custkey = o_custkey GROUP BY 1, 2
""")
def customer_order_stats(spark: SparkSession, data: str) -> DataFrame:
    totals = joins.order_totals(customers(spark, data), orders(spark, data))
    return rounded(totals, "avg_order_value")


@query("""
SELECT c_name AS name, o_orderkey AS order_id, strftime(o_orderdate, '%Y-%m-%d') AS order_date
FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_mktsegment = 'MACHINERY'
""")
def active_customer_orders(spark: SparkSession, data: str) -> DataFrame:
    active = F.col("c_mktsegment") == "MACHINERY"
    rows = joins.customer_orders(customers(spark, data), orders(spark, data), active)
    return text(rows.select("name", "order_id", "order_date"), "order_date")


@query(f"""
WITH {OPPORTUNITIES}
SELECT Salesperson, count("Lead Name") AS total_leads,
       CAST(sum(CAST("Forecasted Monthly Revenue" AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM opportunities WHERE "Date" BETWEEN DATE '{START}' AND DATE '{END}' GROUP BY 1
""")
def revenue_by_salesperson(spark: SparkSession, data: str) -> DataFrame:
    rows = date_range(opportunities(spark, data), "Date", START, END)
    return aggregates.revenue_by_salesperson(rows).orderBy(F.desc("total_revenue"), "Salesperson")


@query(f"""
WITH {OPPORTUNITIES}
SELECT Region, count(*) AS total_leads,
       CAST(sum(CAST("Forecasted Monthly Revenue" AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue
FROM opportunities WHERE "Date" >= DATE '{START}' GROUP BY 1
""")
def leads_by_region(spark: SparkSession, data: str) -> DataFrame:
    rows = date_range(opportunities(spark, data), "Date", start=START)
    return aggregates.leads_by_region(rows).orderBy(F.desc("total_revenue"), "Region")


@query(f"""
WITH {OPPORTUNITIES}
SELECT "Lead Name", Salesperson, "Forecasted Monthly Revenue"
FROM opportunities WHERE "Date" <= DATE '{END}'
ORDER BY "Forecasted Monthly Revenue" DESC, Salesperson, "Lead Name" NULLS FIRST LIMIT 3
""")
def top_leads(spark: SparkSession, data: str) -> DataFrame:
    rows = date_range(opportunities(spark, data), "Date", end=END)
    revenue = "Forecasted Monthly Revenue"
    order = [F.desc(revenue), F.asc("Salesperson"), F.asc_nulls_first("Lead Name")]
    return ranking.top_n(rows.select("Lead Name", "Salesperson", revenue), order, 3)


@query(f"""
WITH {OPPORTUNITIES}
SELECT strftime(date_trunc('month', "Date"), '%Y-%m-%d') AS month,
       CAST(sum(CAST("Forecasted Monthly Revenue" AS DECIMAL(18,2))) AS DOUBLE) AS total_revenue,
       count(*) AS num_opportunities
FROM opportunities GROUP BY 1
""")
def monthly_revenue(spark: SparkSession, data: str) -> DataFrame:
    months = aggregates.monthly_revenue(date_range(opportunities(spark, data), "Date"))
    return text(months.orderBy(F.desc("month")), "month")


@query(f"""
WITH {OPPORTUNITIES},
months AS (
  SELECT CAST(year("Date") AS INTEGER) AS year, CAST(month("Date") AS INTEGER) AS month,
         sum(CAST("Forecasted Monthly Revenue" AS DECIMAL(18,2))) AS revenue
  FROM opportunities GROUP BY 1, 2)
SELECT year, month, CAST(revenue AS DOUBLE) AS monthly_revenue FROM months
WHERE revenue >= (SELECT avg(revenue) FROM months)
""")
def strong_months(spark: SparkSession, data: str) -> DataFrame:
    rows = opportunities(spark, data)
    return aggregates.strong_months(rows, "Date", "Forecasted Monthly Revenue")


@query("""
SELECT o_orderkey AS order_id,
       CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS amount
FROM orders WHERE CAST(round(o_totalprice * 100) AS BIGINT) / 100 > 10
""")
def cents_to_units(spark: SparkSession, data: str) -> DataFrame:
    amount = columns.cents_to_units(F.col("total_amount")).alias("amount")
    return above(orders(spark, data).select("order_id", amount), "amount", 10.0)


@query("""
SELECT o_orderkey AS order_id, CAST(round(o_totalprice * 100) AS BIGINT) / 100 AS amount
FROM orders WHERE CAST(round(o_totalprice * 100) AS BIGINT) / 100 > 10
ORDER BY o_orderkey LIMIT 10
""")
def first_orders(spark: SparkSession, data: str) -> DataFrame:
    return ranking.top_n(cents_to_units(spark, data), [F.asc("order_id")], 10)


@query("""
SELECT strftime(o_orderdate, '%Y-%m-%d') AS "Date", c_name AS Salesperson,
       CAST(o_orderkey AS VARCHAR) AS "Lead Name",
       strftime(o_orderdate + INTERVAL 30 DAY, '%Y-%m-%d') AS "Target Close",
       o_totalprice AS "Forecasted Monthly Revenue",
       o_orderstatus = 'F' AS "Closed Opportunity", o_orderstatus = 'O' AS "Active Opportunity",
       CASE WHEN o_orderstatus = 'P' THEN TIMESTAMP '2001-08-02 06:00:00' END
         AS "Latest Status Entry"
FROM orders JOIN customer ON o_custkey = c_custkey
""")
def ingest_opportunities(spark: SparkSession, data: str) -> DataFrame:
    status = F.col("o_orderstatus")

    def word(true_when, word_for_true):
        return F.when(true_when, word_for_true).otherwise("FALSE")

    due = F.col("o_orderdate") + F.expr("INTERVAL 30 DAYS")
    rows = table(spark, data, "orders").join(
        table(spark, data, "customer"), F.col("o_custkey") == F.col("c_custkey")
    )
    as_text = rows.select(
        F.date_format("o_orderdate", "M/d/yyyy").alias("Date"),
        F.col("c_name").alias("Salesperson"),
        F.col("o_orderkey").cast("string").alias("Lead Name"),
        F.date_format(due, "MM/dd/yyyy").alias("Target Close"),
        F.col("o_totalprice").cast("string").alias("Forecasted Monthly Revenue"),
        F.col("o_totalprice").cast("string").alias("Weighted Revenue"),
        word(status == "F", "TRUE").alias("Closed Opportunity"),
        word(status == "O", "true").alias("Active Opportunity"),
        word(status == "P", "True").alias("Latest Status Entry"),
    )
    typed = parse_opportunities(as_text, "2001-08-02 06:00:00").drop("Weighted Revenue")
    stamp = F.col("Latest Status Entry").cast("timestamp_ntz")
    return text(typed.withColumn("Latest Status Entry", stamp), "Date", "Target Close")


CONDITION = """CASE o_orderkey % 4 WHEN 0 THEN 'Light Rain' WHEN 1 THEN 'Clouds'
                    WHEN 2 THEN 'Clear' ELSE 'shower rain' END"""


@query(f"""
WITH history AS (
  SELECT o_orderpriority AS city_name, CAST(o_orderdate AS DATE) AS d, o_totalprice AS t,
         CAST(o_custkey % 100 AS DOUBLE) AS h, {CONDITION} AS c
  FROM orders WHERE o_orderdate >= DATE '2000-08-03' AND o_orderdate < DATE '2000-09-02'),
common AS (
  SELECT city_name, d, c FROM history GROUP BY 1, 2, 3
  QUALIFY row_number() OVER (PARTITION BY city_name, d ORDER BY count(*) DESC, c) = 1)
SELECT city_name, strftime(d + INTERVAL 365 DAY, '%Y-%m-%d') AS forecast_date,
       min(t) AS temperature_min, max(t) AS temperature_max,
       round(avg(t), 4) AS temperature_avg, round(round(avg(h), 9), 6) AS humidity,
       any_value(common.c) AS weather_condition,
       round(round(100.0 * count(*) FILTER (WHERE lower(history.c) LIKE '%rain%'
             OR lower(history.c) LIKE '%shower%') / count(*), 9), 6) AS precipitation_probability
FROM history JOIN common USING (city_name, d) GROUP BY city_name, d
""")
def seasonal_forecast(spark: SparkSession, data: str) -> DataFrame:
    rows = table(spark, data, "orders").select(
        F.col("o_orderpriority").alias("city_name"),
        F.col("o_orderdate").alias("measurement_time"),
        F.col("o_totalprice").alias("temperature"),
        (F.col("o_custkey") % 100).cast("double").alias("humidity"),
        F.expr(CONDITION).alias("weather_condition"),
    )
    ahead = series.seasonal_forecast(
        rows, "city_name", "measurement_time", "temperature", "humidity", "weather_condition",
        date(2001, 8, 2), 30,
    )
    ahead = ahead.withColumn("temperature_avg", F.round("temperature_avg", 4))
    return text(rounded(ahead, "humidity", "precipitation_probability"), "forecast_date")
