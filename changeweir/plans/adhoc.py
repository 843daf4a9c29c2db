"""The ad-hoc query catalogue over ``customers`` (c) and ``orders`` (o).

Every function takes the two frames (or one of them) and is lazy. Sorted results
carry a unique tie-break. Orders are pre-summed per customer before they meet the
customers (``operators.aggregates``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from changeweir.functions import columns as fc
from changeweir.operators.aggregates import (
    customers_with_totals,
    daily_totals,
    status_totals,
    totals_by_name,
)
from changeweir.operators.ordering import number_in_group, percent_rank_over_all, rank_over_all


def with_names(c: DataFrame, o: DataFrame) -> DataFrame:
    """Orders with ``name``; a skewed customer is split by AQE when the join is sorted."""
    names = c.select(F.col("id").alias("_cid"), "name")
    return o.join(names, o["customer_id"] == names["_cid"]).drop("_cid")


# -- filters -------------------------------------------------------------------


def filter_high_value(c, o, threshold, strict: bool = False) -> DataFrame:
    keep = F.col("amount") > threshold if strict else F.col("amount") >= threshold
    return with_names(c, o.filter(keep)).select("name", "id", "amount", "status", "order_date").orderBy(
        F.desc("amount"), "id"
    )


def filter_status(c, o, status: str) -> DataFrame:
    return with_names(c, o.filter(F.col("status") == status)).select("name", "id", "amount", "order_date").orderBy(
        "order_date", "id"
    )


def filter_date_range(o, first, last) -> DataFrame:
    between = F.col("order_date").between(F.lit(first).cast("date"), F.lit(last).cast("date"))
    return o.filter(between).orderBy("order_date", "amount", "id")


def filter_in_list(o, above, statuses) -> DataFrame:
    return o.filter((F.col("amount") > above) & F.col("status").isin(*statuses)).orderBy(F.desc("amount"), "id")


def filter_like(c, pattern: str) -> DataFrame:
    return c.filter(F.col("name").like(pattern))


def update_expr(o, factor) -> DataFrame:
    """The order rows after ``SET amount = amount * factor, status = 'delivered'``."""
    new_amount = (F.col("amount") * F.lit(factor)).cast("decimal(10,2)")
    return o.select("id", F.col("amount").alias("old_amount"), new_amount.alias("amount"), F.lit("delivered").alias("status"))


def case_tier(o, silver, gold) -> DataFrame:
    return o.select("id", "amount", fc.tier("amount", silver, gold).alias("tier"))


# -- joins ---------------------------------------------------------------------


def left_join_totals(c, o) -> DataFrame:
    return (
        totals_by_name(c, o, "left")
        .select("name", "order_count", F.coalesce("total_spent", F.lit(0)).cast("decimal(20,2)").alias("total"))
        .orderBy(F.desc("total"), "name")
    )


def customers_without_orders(c, o) -> DataFrame:
    buyers = o.select("customer_id").distinct()  # a hot customer is one row before the join
    return c.join(buyers, c["id"] == buyers["customer_id"], "left_anti").select("name", "email")


def orders_by_customer(c, o) -> DataFrame:
    return with_names(c, o).select("name", "id", "amount", "status").orderBy("name", F.desc("amount"), "id")


def same_amount_chain(rows: DataFrame, key: str, value: str, **options) -> DataFrame:
    """Rows that share a value, linked in key order.

    ``id_2`` is the next row with the value of ``id_1``; ``later_matches`` is the
    number of rows after ``id_1`` with that value. The pairs (a, b), a < b, with
    equal values are ``id_1`` with each row reached along its links, so the sum
    of ``later_matches`` is their number; the output grows with the rows.
    """
    linked = number_in_group(
        rows.filter(F.col(value).isNotNull()).select(key, value),
        value,
        [key],
        descending=True,
        number="_n",
        previous={"_next": key},
        **options,
    )
    return linked.filter(F.col("_next").isNotNull()).select(
        F.col(key).alias("id_1"),
        F.col("_next").alias("id_2"),
        F.col(value).alias("amount"),
        (F.col("_n") - 1).alias("later_matches"),
    )


def customers_above_average(c, o) -> DataFrame:
    spending = totals_by_name(c, o).select("name", F.col("total_spent").alias("total"))
    average = spending.select(fc.mean(F.sum("total"), F.count("total"))).scalar()
    return spending.filter(F.col("total").cast("double") > average).orderBy(F.desc("total"), "name")


def orders_above_own_average(c, o) -> DataFrame:
    """Orders larger than their customer's mean; customer and mean are joined first (one row each)."""
    per_customer = customers_with_totals(c, o, "inner", [F.count("amount").alias("n_amount")]).select(
        F.col("id").alias("_cid"), "name", fc.mean(F.col("total"), F.col("n_amount")).alias("avg_order")
    )
    joined = o.join(per_customer, (o["customer_id"] == per_customer["_cid"]))
    return (
        joined.filter(F.col("amount").cast("double") > F.col("avg_order"))
        .select("name", "id", "amount", "avg_order")
        .orderBy(F.desc("amount"), "id")
    )


# -- aggregates ----------------------------------------------------------------


def revenue_by_customer(c, o) -> DataFrame:
    return totals_by_name(c, o).select("name", "order_count", "total_spent").orderBy(F.desc("total_spent"), "name")


def summary_by_name_email(c, o) -> DataFrame:
    per_customer = customers_with_totals(c, o, "left", [F.count("amount").alias("n_amount")])
    return (
        per_customer.groupBy("name", "email")
        .agg(
            F.sum(F.coalesce("order_count", F.lit(0))).alias("order_count"),
            F.coalesce(F.sum("total"), F.lit(0)).cast("decimal(20,2)").alias("total_spent"),
            F.coalesce(fc.mean(F.sum("total"), F.sum("n_amount")), F.lit(0.0)).alias("avg_order"),
        )
        .orderBy(F.desc("total_spent"), "name", "email")
    )


def revenue_by_status(o) -> DataFrame:
    return (
        status_totals(o)
        .select(
            "status",
            F.col("order_count").alias("orders"),
            F.col("total_amount").alias("revenue"),
            F.col("avg_amount").alias("avg_order"),
        )
        .orderBy(F.desc("revenue"), "status")
    )


def daily_revenue(o) -> DataFrame:
    return daily_totals(o).orderBy("order_date")


def spending_tiers(c, o, silver, gold) -> DataFrame:
    return (
        totals_by_name(c, o)
        .select("name", "total_spent", fc.tier("total_spent", silver, gold).alias("tier"))
        .orderBy(F.desc("total_spent"), "name")
    )


def tier_rollup(tiers: DataFrame) -> DataFrame:
    place = F.when(F.col("tier") == "Gold", 1).when(F.col("tier") == "Silver", 2).otherwise(3)
    return (
        tiers.groupBy(F.col("customer_tier").alias("tier"))
        .agg(F.count(F.lit(1)).alias("customer_count"), fc.rounded(F.sum("total_spent")).alias("tier_revenue"))
        .orderBy(place)
    )


def pivot_status_revenue(c, o, statuses=("completed", "pending", "shipped")) -> DataFrame:
    def of_status(status: str) -> Column:
        return fc.money_sum(F.when(F.col("status") == status, F.col("amount"))).alias(f"_{status}")

    wide = customers_with_totals(c, o, "left", [of_status(s) for s in statuses])
    return (
        wide.groupBy("name")
        .agg(
            *[
                F.coalesce(F.sum(f"_{s}"), F.lit(0)).cast("decimal(20,2)").alias(f"{s}_revenue")
                for s in statuses
            ],
            fc.money_sum("total").alias("total_revenue"),
        )
        .orderBy(F.desc("total_revenue"), "name")
    )


def having_count(c, o, more_than: int) -> DataFrame:
    return (
        totals_by_name(c, o)
        .filter(F.col("order_count") > more_than)
        .select("name", "order_count")
        .orderBy(F.desc("order_count"), "name")
    )


def having_sum(o, more_than) -> DataFrame:
    return (
        o.groupBy("status")
        .agg(fc.money_sum("amount").alias("revenue"))
        .filter(F.col("revenue") > more_than)
        .orderBy(F.desc("revenue"), "status")
    )


def distinct_amounts(o) -> DataFrame:
    return o.select("amount").distinct().orderBy(F.desc("amount"))


def unique_customers(o) -> DataFrame:
    return o.agg(F.countDistinct("customer_id").alias("unique_customers"))


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("source"), "row_count")
        for name, df in tables.items()
    ]
    out = counts[0]
    for one in counts[1:]:
        out = out.unionByName(one)
    return out


# -- windows -------------------------------------------------------------------


def customer_spend_rank(c, o, **options) -> DataFrame:
    spending = totals_by_name(c, o).select("name", "total_spent")
    return rank_over_all(spending, "total_spent", "rank", descending=True, **options)


def cumulative_revenue(o) -> DataFrame:
    """Running total over days. The window sees one row per calendar day, never orders."""
    days = daily_totals(o).select("order_date", F.col("revenue").alias("daily_revenue"))
    running = F.sum("daily_revenue").over(Window.orderBy("order_date"))
    return days.withColumn("cumulative_revenue", running.cast("decimal(20,2)")).orderBy("order_date")


def moving_average_revenue(o, days: int = 3) -> DataFrame:
    """Mean of each day and the ``days - 1`` rows before it; one row per calendar day."""
    w = Window.orderBy("order_date").rowsBetween(1 - days, 0)
    return (
        daily_totals(o)
        .select(
            "order_date",
            "revenue",
            fc.mean(F.sum("revenue").over(w), F.count("revenue").over(w)).alias("moving_avg"),
        )
        .orderBy("order_date")
    )


def top_orders_per_customer(c, o, n: int = 2) -> DataFrame:
    """The filter on ``rn`` becomes a limit per group below the shuffle: n rows per customer and task move."""
    w = Window.partitionBy("customer_id").orderBy(F.desc("amount"), "id")
    top = (
        o.select("id", "customer_id", "amount", "status")
        .withColumn("rn", F.row_number().over(w).cast("bigint"))
        .filter(F.col("rn") <= n)
    )
    return with_names(c, top).select("name", "id", "amount", "status", "rn").orderBy(
        "name", F.desc("amount"), "id"
    )


def newest_orders(c, o, n: int = 5) -> DataFrame:
    """The newest ``n`` orders of each customer, ranked before names are joined: n rows per customer and task move."""
    w = Window.partitionBy("customer_id").orderBy(F.desc("created_at"), F.desc("id"))
    top = o.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= n)
    names = c.select(F.col("id").alias("_cid"), F.col("name").alias("customer_name"))
    return top.join(names, top["customer_id"] == names["_cid"]).select(
        "customer_id",
        "customer_name",
        F.col("id").alias("order_id"),
        fc.rounded("amount").alias("amount"),
        "status",
        "created_at",
        "rank",
    )


def recent_orders_top(o_joined: DataFrame, n: int = 5) -> DataFrame:
    """The newest ``n`` orders of each customer (int_customer_orders in)."""
    w = Window.partitionBy("customer_id").orderBy(F.desc("order_created_at"), F.desc("order_id"))
    return (
        o_joined.withColumn("rank", F.row_number().over(w).cast("bigint"))
        .filter(F.col("rank") <= n)
        .select(
            "customer_id",
            "customer_name",
            "order_id",
            fc.rounded("amount").alias("amount"),
            "status",
            F.col("order_created_at").alias("created_at"),
            "rank",
        )
    )


def amount_percent_rank(o, **options) -> DataFrame:
    return percent_rank_over_all(o.select("id", "amount"), "amount", "percentile", **options).orderBy(
        F.desc("amount"), "id"
    )


# -- sort, top-k, sets -----------------------------------------------------------


def top_orders(o, n: int = 5) -> DataFrame:
    return o.orderBy(F.desc("amount"), "id").limit(n)


def top_customers(summary: DataFrame, n: int = 10) -> DataFrame:
    return (
        summary.orderBy(F.desc("total_spent"), "customer_id")
        .limit(n)
        .select(
            "customer_id",
            "customer_name",
            "order_count",
            fc.rounded("total_spent").alias("total_spent"),
            fc.rounded("avg_order_amount").alias("avg_amount"),
            "last_order_date",
        )
    )


def last_days(daily: DataFrame, n: int = 7) -> DataFrame:
    return (
        daily.orderBy(F.desc("metric_date"))
        .limit(n)
        .select(
            F.col("metric_date").alias("date"),
            "total_orders",
            fc.rounded("daily_revenue").alias("revenue"),
            fc.rounded("avg_order_value").alias("avg_value"),
            "unique_customers",
        )
    )


def high_value_dashboard(high_value: DataFrame, n: int = 10) -> DataFrame:
    return (
        high_value.orderBy(F.desc("amount"), "order_id")
        .limit(n)
        .select(
            "order_id",
            "customer_name",
            fc.rounded("amount").alias("amount"),
            "status",
            F.col("order_created_at").cast("date").alias("order_date"),
        )
    )


def status_dashboard_rounded(dashboard: DataFrame) -> DataFrame:
    return dashboard.select(
        "status",
        "order_count",
        fc.rounded("total_amount").alias("total_amount"),
        fc.rounded("avg_amount").alias("avg_amount"),
    ).orderBy(F.desc("order_count"), "status")


def sorted_orders(c, o) -> DataFrame:
    return with_names(c, o).select("name", "amount", "status", "id").orderBy(F.asc("name"), F.desc("amount"), "id")


def random_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """``n`` random rows: those of least MD5 of seed and key, so a seed gives the same rows on any cluster or engine.

    Each task keeps its own first ``n``, and samples of parts merge into the sample of the whole.
    """
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), key).limit(n)


def big_spenders_or_named(c, o, above, pattern: str) -> DataFrame:
    """Names with an order above ``above`` UNION names like ``pattern``."""
    # Distinct customers before the join: a hot customer is one row by then.
    buyers = o.filter(F.col("amount") > above).select("customer_id").distinct()
    names = c.join(buyers, c["id"] == buyers["customer_id"], "left_semi").select("name")
    return names.unionByName(c.filter(F.col("name").like(pattern)).select("name")).distinct()


# -- scalar functions -------------------------------------------------------------


def revenue_by_weekday(o) -> DataFrame:
    return (
        daily_totals(o)
        .select("order_date", fc.weekday("order_date").alias("day_of_week"), "orders", "revenue")
        .orderBy("order_date")
    )


def order_ages(o, as_of: Column | None = None) -> DataFrame:
    today = F.current_date() if as_of is None else as_of
    return o.select(
        "id",
        "order_date",
        fc.days_between(today, "order_date").alias("days_ago"),
        fc.month("order_date").alias("month"),
    ).orderBy(F.desc("order_date"), "id")


def truncated_dates(o) -> DataFrame:
    return o.select("id", fc.day("created_at").alias("day"), fc.month("created_at").alias("month"))


def email_domains(c) -> DataFrame:
    return c.select("name", "email", fc.email_domain("email").alias("email_domain"))


def tumbling_daily(o) -> DataFrame:
    """Daily windows over ``created_at``, windows given by their start and end."""
    zoned = o.withColumn("_at", F.col("created_at").cast("timestamp"))
    return (
        zoned.groupBy(F.window("_at", "1 day").alias("w"))
        .agg(F.count(F.lit(1)).alias("total_orders"), fc.money_sum("amount").alias("daily_revenue"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "total_orders",
            "daily_revenue",
        )
    )

