"""Joins, anti joins and key checks.

No side is hinted for broadcast: Catalyst broadcasts a side whose size it knows to be small, and
adaptive execution splits the skewed partitions of the others.
"""

from __future__ import annotations

from datetime import date, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matching(df: DataFrame, other: DataFrame, names: list[str]) -> DataFrame:
    """The rows that agree with some row of ``other`` in all the columns; NULL agrees with NULL."""
    found = other.select(*[F.col(name).alias(f"_m_{name}") for name in names])
    same = [F.col(name).eqNullSafe(F.col(f"_m_{name}")) for name in names]
    return df.join(found, reduce(lambda a, b: a & b, same), "left_semi")


def quantity_by_region_product(sales: DataFrame, products: DataFrame) -> DataFrame:
    """Quantity sold by region and product name.

    Sales are summed by product key before the join, so a best-selling product is a handful of
    rows by then.
    """
    sums = sales.groupBy("region", "product_id").agg(F.sum("quantity").alias("quantity"))
    named = sums.join(products.select("product_id", "product_name"), "product_id")
    return named.groupBy("region", "product_name").agg(F.sum("quantity").alias("total_sold"))


def order_totals(customers: DataFrame, orders: DataFrame) -> DataFrame:
    """Orders, total and mean amount per customer that has any; orders are summed before the
    join."""
    sums = orders.groupBy("customer_id").agg(
        F.count("order_id").alias("total_orders"),
        F.sum("total_amount").alias("total_spent"),
        F.avg("total_amount").alias("avg_order_value"),
    )
    return customers.join(sums, "customer_id").select(
        "customer_id",
        F.col("name").alias("customer_name"),
        "total_orders",
        "total_spent",
        "avg_order_value",
    )


def customer_orders(customers: DataFrame, orders: DataFrame, only: Column) -> DataFrame:
    """Orders of the selected customers."""
    return customers.filter(only).join(orders, "customer_id")


def missing_grid(
    df: DataFrame, keys: DataFrame, key: str, day: str, as_of: date, days: int
) -> DataFrame:
    """All (day, key) pairs of the ``days`` days up to and including ``as_of`` without a row."""
    start = as_of - timedelta(days=days - 1)
    calendar = F.sequence(F.lit(start), F.lit(as_of), F.expr("INTERVAL 1 DAY"))
    grid = keys.select(key).distinct().select(F.explode(calendar).alias("date"), key)
    seen = (
        df.filter(F.col(day).between(F.lit(start), F.lit(as_of)))
        .select(F.col(day).alias("date"), key)
        .distinct()
    )
    return grid.join(seen, ["date", key], "left_anti")


def missing_keys(expected: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(observed.select(key).distinct(), key, "left_anti")


def require_keys(expected: DataFrame, observed: DataFrame, key: str, show: int = 20) -> None:
    """Fail when an expected key has no row; the message lists the first few."""
    gaps = [row[0] for row in missing_keys(expected, observed, key).limit(show).collect()]
    if gaps:
        raise ValueError(f"no rows for {key}: {', '.join(map(str, gaps))}")


def orphans(child: DataFrame, parent: DataFrame, child_key: str, parent_key: str) -> DataFrame:
    """Child rows whose parent does not exist; a NULL reference is allowed."""
    known = parent.select(F.col(parent_key).alias(child_key))
    return child.filter(F.col(child_key).isNotNull()).join(known, child_key, "left_anti")


def absent_rows(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    return new.join(target.select(key), key, "left_anti")


def insert_if_absent(target: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The target with those new rows whose key it lacks."""
    return target.unionByName(absent_rows(target, new, key))
