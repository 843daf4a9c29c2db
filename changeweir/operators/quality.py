"""Data-quality rules, source-to-sink reconciliation and pipeline latency."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


@dataclass(frozen=True)
class Rule:
    """``kind``: unique, not_null, relationships (``arg`` = (table, column)) or expression (``arg`` = SQL)."""

    table: str
    kind: str
    column: str = ""
    arg: tuple[str, str] | str | None = None

    @property
    def name(self) -> str:
        return "_".join(x for x in (self.kind, self.table, self.column) if x)


#: The rules declared on the sources and the marts.
SALES_RULES = (
    Rule("customers_cdc", "unique", "id"),
    Rule("customers_cdc", "not_null", "id"),
    Rule("customers_cdc", "not_null", "name"),
    Rule("customers_cdc", "unique", "email"),
    Rule("customers_cdc", "not_null", "email"),
    Rule("orders_cdc", "unique", "id"),
    Rule("orders_cdc", "not_null", "id"),
    Rule("orders_cdc", "not_null", "customer_id"),
    Rule("orders_cdc", "relationships", "customer_id", ("stg_customers", "customer_id")),
    Rule("orders_cdc", "not_null", "amount"),
    Rule("orders_cdc", "not_null", "status"),
    Rule("fct_customer_order_summary", "unique", "customer_id"),
    Rule("fct_customer_order_summary", "not_null", "customer_id"),
    Rule("fct_customer_order_summary", "not_null", "total_spent"),
    Rule("fct_high_value_orders", "expression", "", "amount >= 100"),
    Rule("dim_customer_spending_tier", "not_null", "customer_tier"),
    Rule("fct_daily_order_metrics", "not_null", "metric_date"),
    Rule("fct_daily_order_metrics", "not_null", "daily_revenue"),
)


def not_unique(df: DataFrame, column: str) -> DataFrame:
    """Values that occur more than once, with how often. Counted before the shuffle."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(F.col(column).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 1)
    )


def nulls_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``column_name, n_failed`` for all columns from one scan."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (column_name, n_failed)")


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_column: str) -> DataFrame:
    """Rows whose reference names no parent.

    The distinct references are checked, not the rows, so a parent with a third of
    the rows is one row there; the rows come back by the missing references only.
    """
    missing = (
        child.filter(F.col(column).isNotNull())
        .select(F.col(column).alias("_missing"))
        .distinct()
        .join(parent.select(F.col(parent_column).alias("_parent")), F.col("_missing") == F.col("_parent"), "left_anti")
    )
    return child.join(missing, child[column] == missing["_missing"], "left_semi")


def violations(df: DataFrame, expression: str) -> DataFrame:
    """Rows for which ``expression`` is not true (false or unknown)."""
    return df.filter(~F.coalesce(F.expr(expression), F.lit(False)))


def failures(rule: Rule, frames: Mapping[str, DataFrame]) -> DataFrame:
    df = frames[rule.table]
    if rule.kind == "unique":
        return not_unique(df, rule.column)
    if rule.kind == "not_null":
        return df.filter(F.col(rule.column).isNull())
    if rule.kind == "relationships":
        table, column = rule.arg
        return orphans(df, rule.column, frames[table], column)
    if rule.kind == "expression":
        return violations(df, rule.arg)
    raise ValueError(f"unknown rule kind {rule.kind}")


def summary(frames: Mapping[str, DataFrame], rules: Sequence[Rule]) -> DataFrame:
    """``rule, n_failed`` per rule. The null and expression rules of a table share one scan."""
    parts = []
    for table in dict.fromkeys(r.table for r in rules):
        scans = {r.name: _broken(r) for r in rules if r.table == table and r.kind in ("not_null", "expression")}
        if scans:
            counts = frames[table].agg(*[F.count_if(broken).alias(name) for name, broken in scans.items()])
            pairs = ", ".join(f"'{name}', `{name}`" for name in scans)
            parts.append(counts.selectExpr(f"stack({len(scans)}, {pairs}) AS (rule, n_failed)"))
        for r in rules:
            if r.table == table and r.kind in ("unique", "relationships"):
                n = failures(r, frames).agg(F.count(F.lit(1)).alias("n_failed"))
                parts.append(n.select(F.lit(r.name).alias("rule"), "n_failed"))
    return reduce(DataFrame.unionByName, parts)


def _broken(rule: Rule) -> Column:
    if rule.kind == "not_null":
        return F.col(rule.column).isNull()
    return ~F.coalesce(F.expr(rule.arg), F.lit(False))


def store_failures(
    spark: SparkSession, frames: Mapping[str, DataFrame], rules: Sequence[Rule], root: str
) -> dict[str, DataFrame]:
    """Write each rule's failing rows to ``root/<rule>`` and give the saved tables."""
    saved = {}
    for rule in rules:
        path = f"{root}/{rule.name}"
        failures(rule, frames).write.mode("overwrite").parquet(path)
        saved[rule.name] = spark.read.parquet(path)
    return saved


# -- reconciliation -----------------------------------------------------------------


def count_by_stage(stages: Mapping[str, DataFrame]) -> DataFrame:
    """``stage, rows`` for copies of one table along the pipeline."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
        for name, df in stages.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def differences(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys that two copies of a keyed table do not agree on: one join by key, rows compared whole."""
    columns = [c for c in left.columns if c != key]
    l = left.select(F.col(key).alias("_lk"), F.struct(*columns).alias("_l"))
    r = right.select(F.col(key).alias("_rk"), F.struct(*columns).alias("_r"))
    finding = (
        F.when(F.col("_rk").isNull(), "only_left").when(F.col("_lk").isNull(), "only_right").otherwise("changed")
    )
    return (
        l.join(r, F.col("_lk") == F.col("_rk"), "full_outer")
        .filter(~F.col("_l").eqNullSafe(F.col("_r")))
        .select(F.coalesce("_lk", "_rk").alias(key), finding.alias("finding"))
    )


def bucket_sums(df: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """``bucket, rows, checksum`` of a keyed copy: rows dealt by hash of their key, 64-bit hashes of whole rows added up.

    Sums are combined before the shuffle, so whatever the table's size each task sends at most ``buckets`` rows.
    """
    columns = [c for c in df.columns if c not in key]
    return df.groupBy(F.pmod(F.xxhash64(*key), F.lit(buckets)).alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(F.xxhash64(*key, *columns).cast("decimal(38,0)")).alias("checksum")
    )


def differing_buckets(left: DataFrame, right: DataFrame, key: Sequence[str], buckets: int) -> DataFrame:
    """``bucket``: those whose rows or checksums the two copies don't agree on; at most ``buckets`` rows."""
    l, r = (bucket_sums(df, key, buckets) for df in (left, right.select(*left.columns)))
    l, r = l.withColumnsRenamed({"rows": "_lr", "checksum": "_lc", "bucket": "_lb"}), r.withColumnsRenamed({"rows": "_rr", "checksum": "_rc"})
    same = F.col("_lr").eqNullSafe(F.col("_rr")) & F.col("_lc").eqNullSafe(F.col("_rc"))
    return l.join(r, l["_lb"] == r["bucket"], "full_outer").filter(~same).select(F.coalesce("_lb", "bucket").alias("_differs"))


def differences_by_bucket(left: DataFrame, right: DataFrame, key: str, buckets: int = 4096) -> DataFrame:
    """``differences`` for copies that mostly agree: only rows of buckets whose checksums differ are shuffled by key.

    Two differing buckets pass for equal once in 2^64 or so (their row hashes would have to add up alike). Both copies are
    scanned twice, the first time for two numbers a bucket.
    """
    right = right.select(*left.columns)
    found = F.broadcast(differing_buckets(left, right, [key], buckets))  # at most ``buckets`` rows
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets))
    l, r = (df.join(found, bucket == F.col("_differs"), "left_semi") for df in (left, right))
    return differences(l, r, key)


# -- latency -------------------------------------------------------------------------


def latency_ms(commit_ts: str, sink_ts: str) -> Column:
    """Milliseconds from source commit to sink commit."""
    micros = F.unix_micros(F.col(sink_ts).cast("timestamp")) - F.unix_micros(F.col(commit_ts).cast("timestamp"))
    return F.floor(micros / 1000).cast("bigint")


def latency_summary(rows: DataFrame, by: Sequence[str], ms: str = "latency_ms") -> DataFrame:
    """Count, mean, percentiles and maximum; a percentile is the least value that has so many hundredths of the rows up to it.

    Values are counted before the shuffle. They are ranked in ranges, 16 to each power of two; the ranges'
    totals say how many rows lie ahead of each.
    """
    by, named = list(by), [F.col(c).alias(f"_b_{c}") for c in by]
    counted = rows.groupBy(*by, F.col(ms).alias("_ms")).agg(F.count(ms).alias("_n"))
    counted = counted.withColumn("_range", _latency_range(F.col("_ms")))
    along = Window.partitionBy(*by).orderBy("_range")
    ranges = counted.groupBy(*by, "_range").agg(F.sum("_n").alias("_rows"))
    ranges = ranges.select(
        *named,
        F.col("_range").alias("_b__range"),
        (F.sum("_rows").over(along) - F.col("_rows")).alias("_ahead"),
        F.sum("_rows").over(Window.partitionBy(*by)).alias("_total"),
    )
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_b_{c}")) for c in [*by, "_range"]])
    place = F.col("_ahead") + F.sum("_n").over(Window.partitionBy(*by, "_range").orderBy("_ms"))
    placed = counted.join(ranges, same).withColumn("_place", place)
    return placed.groupBy(*by).agg(
        F.sum("_n").alias("n"),
        (F.sum(F.col("_ms") * F.col("_n")).cast("double") / F.nullif(F.sum("_n"), F.lit(0))).alias("avg_ms"),
        *[
            F.min(F.when(F.col("_place") * 100 >= F.col("_total") * q, F.col("_ms"))).alias(name)
            for name, q in (("p50_ms", 50), ("p95_ms", 95), ("p99_ms", 99))
        ],
        F.max("_ms").alias("max_ms"),
    )


def _latency_range(ms: Column) -> Column:
    """Ranges of latencies in order: by sign, by magnitude, and 16 in each power of two."""
    size = F.greatest(F.abs(ms), F.lit(1)).cast("double")
    power = F.floor(F.log2(size))
    place = (power * 16 + F.floor((size / F.pow(F.lit(2.0), power) - 1) * 16)).cast("int") + 1
    return F.when(ms == 0, 0).when(ms > 0, place).otherwise(-place)
