"""Per-customer and per-status totals.

Orders are always summed by their own key first (map-side combine), then joined:
one hot customer costs one partial row per task, and the join moves one row per
customer instead of one per order.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeweir.functions.columns import mean, money_sum


def order_totals(orders: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """``customer_id, order_count, total, last_order_date`` plus ``extra`` aggregates."""
    return orders.groupBy("customer_id").agg(
        F.count("id").alias("order_count"),
        money_sum("amount").alias("total"),
        F.max("order_date").alias("last_order_date"),
        *extra,
    )


def customers_with_totals(customers: DataFrame, orders: DataFrame, how: str, extra: Sequence[Column] = ()) -> DataFrame:
    totals = order_totals(orders, extra)
    return customers.join(totals, customers["id"] == totals["customer_id"], how).drop("customer_id")


def totals_by_name(customers: DataFrame, orders: DataFrame, how: str = "inner") -> DataFrame:
    """Orders summed per customer name; customers that share a name are summed together."""
    return (
        customers_with_totals(customers, orders, how)
        .groupBy("name")
        .agg(F.sum(F.coalesce("order_count", F.lit(0))).alias("order_count"), money_sum("total").alias("total_spent"))
    )


def status_totals(orders: DataFrame) -> DataFrame:
    return (
        orders.groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money_sum("amount").alias("total_amount"),
            F.count("amount").alias("_n"),
            F.min("order_date").alias("earliest_order"),
            F.max("order_date").alias("latest_order"),
        )
        .withColumn("avg_amount", mean(F.col("total_amount"), F.col("_n")))
        .drop("_n")
    )


def daily_totals(orders: DataFrame) -> DataFrame:
    """Orders and revenue per ``order_date``: at most one row per calendar day."""
    return orders.groupBy("order_date").agg(
        F.count(F.lit(1)).alias("orders"), money_sum("amount").alias("revenue")
    )
