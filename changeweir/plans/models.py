"""The layered models: staging, intermediate, marts, and running them in order."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from decimal import Decimal
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeweir.functions.columns import day, mean, money_sum, tier
from changeweir.operators.ordering import number_in_group
from changeweir.schemas import MONEY_SUM

Frames = dict[str, DataFrame]


@dataclass(frozen=True)
class Thresholds:
    """Amounts the marts cut at; the defaults are the shop's own."""

    high_value: Decimal = Decimal(100)
    silver: Decimal = Decimal(100)
    gold: Decimal = Decimal(500)


@dataclass(frozen=True)
class Model:
    layer: str
    needs: tuple[str, ...]
    build: Callable[[Frames, Thresholds], DataFrame]
    key: tuple[str, ...]


MODELS: dict[str, Model] = {}


def model(layer: str, needs: Iterable[str], key: Iterable[str]):
    def register(build):
        MODELS[build.__name__] = Model(layer, tuple(needs), build, tuple(key))
        return build

    return register


@model("staging", ["customers_cdc"], ["customer_id"])
def stg_customers(f: Frames, _: Thresholds) -> DataFrame:
    return f["customers_cdc"].select(
        F.col("id").alias("customer_id"),
        F.col("name").alias("customer_name"),
        F.col("email").alias("customer_email"),
        F.col("created_at").alias("customer_created_at"),
    )


@model("staging", ["orders_cdc"], ["order_id"])
def stg_orders(f: Frames, _: Thresholds) -> DataFrame:
    return f["orders_cdc"].select(
        F.col("id").alias("order_id"),
        "customer_id",
        "order_date",
        "amount",
        "status",
        F.col("created_at").alias("order_created_at"),
    )


@model("intermediate", ["stg_customers", "stg_orders"], ["order_id"])
def int_customer_orders(f: Frames, _: Thresholds) -> DataFrame:
    return f["stg_orders"].join(f["stg_customers"], "customer_id").select(
        "order_id",
        "customer_id",
        "customer_name",
        "customer_email",
        "amount",
        "order_date",
        "status",
        "order_created_at",
    )


@model("marts", ["stg_customers", "stg_orders"], ["customer_id"])
def fct_customer_order_summary(f: Frames, _: Thresholds) -> DataFrame:
    totals = f["stg_orders"].groupBy("customer_id").agg(
        F.count("order_id").alias("n"),
        F.count("amount").alias("n_amount"),
        money_sum("amount").alias("total"),
        F.max("order_date").alias("last_order_date"),
    )
    return summary_of(f["stg_customers"], totals)


def summary_of(customers: DataFrame, totals: DataFrame) -> DataFrame:
    """Every staged customer with its totals (``n, n_amount, total, last_order_date``)."""
    return customers.join(totals, "customer_id", "left").select(
        "customer_id",
        "customer_name",
        "customer_email",
        F.coalesce("n", F.lit(0)).alias("order_count"),
        F.coalesce("total", F.lit(0)).cast(MONEY_SUM).alias("total_spent"),
        F.coalesce(mean(F.col("total"), F.col("n_amount")), F.lit(0.0)).alias("avg_order_amount"),
        "last_order_date",
    )


@model("marts", ["int_customer_orders"], ["order_id"])
def fct_high_value_orders(f: Frames, t: Thresholds) -> DataFrame:
    return f["int_customer_orders"].filter(F.col("amount") >= t.high_value)


@model("marts", ["stg_orders"], ["status"])
def fct_order_status_dashboard(f: Frames, _: Thresholds) -> DataFrame:
    return (
        f["stg_orders"]
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            money_sum("amount").alias("total_amount"),
            mean(F.sum("amount"), F.count("amount")).alias("avg_amount"),
            F.min("order_date").alias("earliest_order"),
            F.max("order_date").alias("latest_order"),
        )
    )


@model("marts", ["stg_orders"], ["metric_date"])
def fct_daily_order_metrics(f: Frames, _: Thresholds) -> DataFrame:
    # Customers of a day first, then the day: COUNT DISTINCT becomes a count of
    # rows, and a hot day or customer is combined before either shuffle.
    per_customer = (
        f["stg_orders"]
        .groupBy(day("order_created_at").alias("metric_date"), "customer_id")
        .agg(
            F.count(F.lit(1)).alias("n"), F.count("amount").alias("n_amount"), money_sum("amount").alias("total")
        )
    )
    return daily_of(per_customer)


def daily_of(per_customer: DataFrame) -> DataFrame:
    """Day metrics from ``metric_date, customer_id, n, n_amount, total``."""
    return (
        per_customer.groupBy("metric_date")
        .agg(
            F.sum("n").alias("total_orders"),
            money_sum("total").alias("daily_revenue"),
            mean(F.sum("total"), F.sum("n_amount")).alias("avg_order_value"),
            F.count("customer_id").alias("unique_customers"),
        )
    )


@model("marts", ["fct_customer_order_summary"], ["customer_id"])
def dim_customer_spending_tier(f: Frames, t: Thresholds) -> DataFrame:
    return f["fct_customer_order_summary"].select(
        "customer_id",
        "customer_name",
        "customer_email",
        "total_spent",
        "order_count",
        tier("total_spent", t.silver, t.gold).alias("customer_tier"),
    )


@model("marts", ["int_customer_orders"], ["order_id"])
def recent_orders(f: Frames, _: Thresholds) -> DataFrame:
    """Every order with its place among its customer's orders, newest first."""
    rows = f["int_customer_orders"].select(
        "customer_id",
        "customer_name",
        "order_id",
        "amount",
        "status",
        F.col("order_created_at").alias("created_at"),
    )
    return number_in_group(rows, "customer_id", ["created_at", "order_id"], descending=True, number="rank")


def run_order(wanted: Iterable[str] | None = None) -> list[str]:
    """Models in dependency order; ``wanted`` keeps those and what they need."""
    names = set(MODELS) if wanted is None else set()
    todo = list(wanted or [])
    while todo:
        name = todo.pop()
        if name in MODELS and name not in names:
            names.add(name)
            todo.extend(MODELS[name].needs)
    graph = {n: [d for d in MODELS[n].needs if d in MODELS] for n in sorted(names)}
    return list(TopologicalSorter(graph).static_order())


def build_models(sources: Frames, thresholds: Thresholds = Thresholds(), wanted: Iterable[str] | None = None) -> Frames:
    """Models as lazy frames; Catalyst inlines view on view."""
    frames = dict(sources)
    for name in run_order(wanted):
        frames[name] = MODELS[name].build(frames, thresholds)
    return frames


def save_models(
    spark: SparkSession,
    sources: Frames,
    root: str,
    thresholds: Thresholds = Thresholds(),
    wanted: Iterable[str] | None = None,
) -> Frames:
    """Full refresh: write each model to ``root/<layer>/<name>``; later ones read the saved tables."""
    frames = dict(sources)
    for name in run_order(wanted):
        path = f"{root}/{MODELS[name].layer}/{name}"
        MODELS[name].build(frames, thresholds).write.mode("overwrite").parquet(path)
        frames[name] = spark.read.parquet(path)
    return frames
