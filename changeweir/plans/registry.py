"""The registered queries: catalogue functions bound to the driver's tables.

Amounts in those tables run from 1,000 to 500,000, so the shop's thresholds
(100 / 500) are scaled as FIXTURES.md says.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeweir.functions import changes as fch
from changeweir.operators import apply, decode, quality
from changeweir.operators.apply import apply_changes, live, with_meta
from changeweir.operators.decode import from_envelopes, route, row_images, to_records
from changeweir.operators.lake import LakeTable, read_glob
from changeweir.plans import adhoc
from changeweir.plans.models import MODELS, Thresholds, build_models, run_order, save_models
from changeweir.schemas import SALES, SHOP
from changeweir.session import scratch_folder
from changeweir.sources import exports
from changeweir.sources import fixtures as fx
from changeweir.sources.feeds import change_source, topic_rows
from changeweir.streaming.pipeline import ChangePipeline, append_sink, without_repeats_within
from changeweir.streaming.rules import KeptRules

Query = Callable[[SparkSession, str], DataFrame]

AT_SCALE = Thresholds(high_value=Decimal(400_000), silver=Decimal(1_500_000), gold=Decimal(2_500_000))

QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def _add(name: str, fn: Query) -> None:
    QUERIES[name] = fn


def sources(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {"customers_cdc": fx.customers(spark, sf), "orders_cdc": fx.orders(spark, sf)}


def one_model(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return build_models(sources(spark, sf), AT_SCALE, [name])[name]


def _model_query(key: str, name: str) -> None:
    _add(key, lambda spark, sf: one_model(spark, sf, name))


def _co(key: str, fn: Callable[[DataFrame, DataFrame], DataFrame]) -> None:
    _add(key, lambda spark, sf: fn(fx.customers(spark, sf), fx.orders(spark, sf)))


def _o(key: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _add(key, lambda spark, sf: fn(fx.orders(spark, sf)))


def _c(key: str, fn: Callable[[DataFrame], DataFrame]) -> None:
    _add(key, lambda spark, sf: fn(fx.customers(spark, sf)))


# models
_model_query("stg_customers", "stg_customers")
_model_query("stg_orders", "stg_orders")
_model_query("int_customer_orders", "int_customer_orders")
_model_query("customer_order_summary", "fct_customer_order_summary")
_model_query("high_value_orders", "fct_high_value_orders")
_model_query("order_status_dashboard", "fct_order_status_dashboard")
_model_query("daily_order_metrics", "fct_daily_order_metrics")
_model_query("customer_spending_tier", "dim_customer_spending_tier")
_model_query("recent_orders", "recent_orders")

# projections and filters
_o("select_all_orders", lambda o: o)
_co("filter_high_value", lambda c, o: adhoc.filter_high_value(c, o, AT_SCALE.high_value, strict=True))
_co("filter_pending", lambda c, o: adhoc.filter_status(c, o, "pending"))
_o("filter_date_range", lambda o: adhoc.filter_date_range(o, "1996-01-15", "1996-03-17"))
_o("filter_in_list", lambda o: adhoc.filter_in_list(o, Decimal(250_000), ["completed", "shipped"]))
_c("filter_like", lambda c: adhoc.filter_like(c, "%77%"))
_o("case_tier", lambda o: adhoc.case_tier(o, Decimal(150_000), Decimal(350_000)))
_o("update_expr", lambda o: adhoc.update_expr(o, Decimal("1.1")))

# joins
_co("left_join_totals", adhoc.left_join_totals)
_co("customers_without_orders", adhoc.customers_without_orders)
_co("orders_above_own_avg", adhoc.orders_above_own_average)
_co("customers_above_avg_spend", adhoc.customers_above_average)


@query
def self_join_same_amount(spark, sf):
    return adhoc.same_amount_chain(fx.table(spark, sf, "events"), "event_id", "value")


# aggregates
_co("revenue_by_customer", adhoc.revenue_by_customer)
_co("summary_by_name_email", adhoc.summary_by_name_email)
_o("revenue_by_status", adhoc.revenue_by_status)
_o("daily_revenue", adhoc.daily_revenue)
_co("spending_tier_adhoc", lambda c, o: adhoc.spending_tiers(c, o, AT_SCALE.silver, AT_SCALE.gold))
_add("tier_rollup", lambda spark, sf: adhoc.tier_rollup(one_model(spark, sf, "dim_customer_spending_tier")))
_co("pivot_status_revenue", adhoc.pivot_status_revenue)
_co("having_count", lambda c, o: adhoc.having_count(c, o, 10))
_o("having_sum", lambda o: adhoc.having_sum(o, Decimal(200_000_000)))
_o("distinct_amounts", adhoc.distinct_amounts)
_o("unique_customers", adhoc.unique_customers)
_co("row_counts", lambda c, o: adhoc.row_counts({"customers_cdc": c, "orders_cdc": o}))

# windows
_co("customer_spend_rank", adhoc.customer_spend_rank)
_o("cumulative_revenue", adhoc.cumulative_revenue)
_co("top2_per_customer", adhoc.top_orders_per_customer)
_o("amount_percent_rank", adhoc.amount_percent_rank)
_o("moving_avg_revenue", adhoc.moving_average_revenue)
_co("recent_orders_top5", adhoc.newest_orders)

# sort, top-k, sets
_co("order_multi", adhoc.sorted_orders)
_co("inner_join_sorted", adhoc.orders_by_customer)
_o("top5_orders", adhoc.top_orders)
_add("top10_customers", lambda spark, sf: adhoc.top_customers(one_model(spark, sf, "fct_customer_order_summary")))
_add("last7_days", lambda spark, sf: adhoc.last_days(one_model(spark, sf, "fct_daily_order_metrics")))
_add(
    "high_value_dashboard",
    lambda spark, sf: adhoc.high_value_dashboard(one_model(spark, sf, "fct_high_value_orders")),
)
_add(
    "dashboard_rounded",
    lambda spark, sf: adhoc.status_dashboard_rounded(one_model(spark, sf, "fct_order_status_dashboard")),
)
_c("random_customers", lambda c: adhoc.random_rows(c, 2, "id", seed=7))
_co("union_distinct_names", lambda c, o: adhoc.big_spenders_or_named(c, o, Decimal(450_000), "%77%"))

# scalar functions
_o("scalar_dates", adhoc.truncated_dates)
_o("revenue_by_dow", adhoc.revenue_by_weekday)
_o("scalar_days_ago", lambda o: adhoc.order_ages(o, F.lit("2025-01-31").cast("date")))
_c("email_domain", adhoc.email_domains)
_o("tumbling_daily", adhoc.tumbling_daily)


# -- decoding ------------------------------------------------------------------------

SNAPSHOT_TIME = "TIMESTAMP_NTZ'2000-01-01 00:00:00'"
#: Spellings of modification types a source may use.
SPELLINGS = ["INSERT", "insert", "REPLACE_ROW", "row_delete", "row_update", "zzz", "Delete", "insert_or_update"]


def _raw_types(spark, sf):
    """Order changes under a source's own names for their types; every ninth has none."""
    names = F.array(*[F.lit(s) for s in SPELLINGS])
    raw = F.when(F.col("id") % 9 != 8, F.element_at(names, (F.col("id") % 9 + 1).cast("int")))
    return fx.order_changes(spark, sf).withColumn("raw_type", raw)


def _shop_tables(spark, sf):
    return {
        "customers": (fx.shop_customers(spark, sf), SHOP["customers"]),
        "products": (fx.shop_products(spark, sf), SHOP["products"]),
        "orders": (fx.shop_orders(spark, sf), SHOP["orders"]),
    }


def _sales_records(spark, sf):
    return to_records(fx.order_changes(spark, sf), SALES["orders"], "analytics").unionByName(
        to_records(fx.customer_changes(spark, sf), SALES["customers"], "analytics")
    )


@query
def kafka_envelope_rows(spark, sf):
    rows = topic_rows(fx.envelopes(spark, sf))
    return rows.select("topic", "partition", "offset", F.col("value").cast("string").alias("value"))


@query
def envelope_after(spark, sf):
    """Every seventh message comes wrapped in ``payload``."""
    wrapped = F.when(F.col("offset") % 7 == 0, F.concat(F.lit('{"payload":'), "value", F.lit("}"))).otherwise(F.col("value"))
    return from_envelopes(fx.envelopes(spark, sf).withColumn("value", wrapped)).select("topic", "offset", "op", "after")


def _topic_decoded(spark, sf):
    records = decode.envelope_records(fx.order_topic(spark, sf))
    return records, decode.decode_all(records, {"orders": SALES["orders"]})


@query
def envelope_state(spark, sf):
    """A topic's messages as a keyed table, ordered over partitions by time, partition and offset."""
    _, decoded = _topic_decoded(spark, sf)
    return live(apply_changes(None, decode.accepted(decoded["orders"], SALES["orders"]), SALES["orders"]))


@query
def envelope_rejects(spark, sf):
    """Messages that are no JSON, have no image or an unknown operation, each with its reason."""
    return decode.rejected(*_topic_decoded(spark, sf)).select("table_name", "reason", "data", "commit_ts", "seq")


@query
def snapshot_as_changes(spark, sf):
    return decode.snapshot_as_changes(fx.customers(spark, sf), "customers", F.expr(SNAPSHOT_TIME))


@query
def snapshot_all_tables(spark, sf):
    return decode.snapshot_records(_shop_tables(spark, sf), "ecommerce", F.expr(SNAPSHOT_TIME)).drop("old_data")


@query
def mod_type_normalize(spark, sf):
    rows = _raw_types(spark, sf).select("id", "seq", "raw_type", fch.mod_type(F.col("raw_type")).alias("mod_type"))
    return rows.withColumn("rejected", F.col("mod_type").isNull())


@query
def change_records(spark, sf):
    return to_records(fx.order_changes(spark, sf), SALES["orders"], "ecommerce").drop("old_data")


def _images(spark, sf):
    return row_images(fx.order_changes(spark, sf), SALES["orders"])


@query
def change_audit_images(spark, sf):
    flat = [F.col(f"{side}.{c}").alias(f"{side}_{c}") for side in ("before", "after") for c in ("amount", "status")]
    return _images(spark, sf).select("id", "mod_type", "seq", *flat)


@query
def change_audit_diff(spark, sf):
    return decode.audit_diff(_images(spark, sf), SALES["orders"])


@query
def route_targets(spark, sf):
    """Change records of all tables, each with the table it goes to."""
    rows = _sales_records(spark, sf).drop("target_table")
    return route(rows, "ecommerce").select("table_name", "mod_type", "seq", "data", "target_table")


@query
def route_counts(spark, sf):
    shop = decode.snapshot_records(_shop_tables(spark, sf), "ecommerce", F.expr(SNAPSHOT_TIME))
    return shop.unionByName(_sales_records(spark, sf)).groupBy("target_table").agg(F.count(F.lit(1)).alias("records"))


@query
def route_unknown(spark, sf):
    """Every tenth order change names a table nobody declared."""
    rows = fx.order_changes(spark, sf).withColumn(
        "table_name", F.when(F.col("id") % 10 == 3, "invoices").when(F.col("id") % 10 == 4, None).otherwise("orders")
    )
    return decode.unknown_tables(rows, SHOP).select("table_name", "id", "seq", "mod_type")


def _decoded_feed(spark, sf):
    return decode.decode_table(fx.raw_order_feed(spark, sf).withColumn("mod_type", F.lit("INSERT")), SHOP["orders"])


@query
def typed_rows(spark, sf):
    return _decoded_feed(spark, sf).filter("reason = ''").select(*SHOP["orders"].columns)


@query
def default_timestamps(spark, sf):
    rows = fx.shop_orders(spark, sf).select(
        "order_id",
        F.when(F.col("order_id") % 3 != 0, F.col("created_at")).alias("created_at"),
        F.when(F.col("order_id") % 4 != 0, F.col("updated_at")).alias("updated_at"),
        F.expr("created_at + INTERVAL 1 HOUR").alias("commit_ts"),
    )
    return decode.default_times(rows)


@query
def missing_key_rejects(spark, sf):
    return _decoded_feed(spark, sf).filter(F.col("reason").contains("missing order_id")).select("seq", "reason", "data")


@query
def corrupt_rows(spark, sf):
    return _decoded_feed(spark, sf).filter("reason = 'not json'").select("seq", "reason", "data")


@query
def bad_value_rejects(spark, sf):
    return _decoded_feed(spark, sf).filter(F.col("reason").contains("bad ")).select("seq", "reason")


@query
def schema_project(spark, sf):
    """Rows with a column too many and one too few, in the target's columns and types."""
    rows = fx.shop_orders(spark, sf).drop("updated_at").withColumn("coupon", F.lit("X1"))
    return rows.to(SHOP["orders"].schema)


@query
def primary_key_text(spark, sf):
    keys = [
        df.select(F.lit(name).alias("table_name"), fch.key_text(spec).alias("primary_key"))
        for name, (df, spec) in _shop_tables(spark, sf).items()
    ]
    return reduce(DataFrame.unionByName, keys)


@query
def insert_defaults(spark, sf):
    rows = fx.orders(spark, sf).select(
        "id",
        "customer_id",
        F.when(F.col("id") % 4 != 0, F.col("order_date")).alias("order_date"),
        "amount",
        F.when(F.col("id") % 3 != 0, F.col("status")).alias("status"),
        F.when(F.col("id") % 5 != 0, F.col("created_at")).alias("created_at"),
    )
    return decode.insert_defaults(rows, SALES["orders"], F.expr("TIMESTAMP_NTZ'2025-01-31 12:00:00'"))


# -- applying changes ------------------------------------------------------------------


def _orders_state(spark, sf):
    return apply_changes(None, fx.order_changes(spark, sf), SALES["orders"])


@query
def latest_per_key(spark, sf):
    rows = _orders_state(spark, sf)
    return rows.select("id", "amount", "status", F.col("_op").alias("mod_type"), F.col("_commit_ts").alias("commit_ts"))


@query
def apply_changes_final(spark, sf):
    return live(_orders_state(spark, sf))


@query
def deleted_keys(spark, sf):
    return apply.deleted_keys(_orders_state(spark, sf), ["id"])


@query
def dedup_changes(spark, sf):
    """The change log with a quarter of it delivered twice."""
    once = fx.order_changes(spark, sf)
    copies = F.when(F.col("id") % 4 == 0, 2).otherwise(1)
    twice = once.withColumn("_copy", F.explode(F.sequence(F.lit(1), copies))).drop("_copy")
    return apply.without_repeats(twice, ["id"])


@query
def late_changes_final(spark, sf):
    """Deletes arrive first, then updates, then inserts."""
    log, state = fx.order_changes(spark, sf), None
    for kind in ("DELETE", "UPDATE", "INSERT"):
        state = apply_changes(state, log.filter(F.col("mod_type") == kind), SALES["orders"])
    return live(state)


@query
def snapshot_then_changes(spark, sf):
    """A snapshot taken in the middle of the log, then the log from thirty days before it."""
    log, spec = fx.order_changes(spark, sf), SALES["orders"]
    at = F.expr("TIMESTAMP_NTZ'1997-01-01 00:00:00'")
    snapshot = live(apply_changes(None, log.filter(F.col("commit_ts") <= at), spec))
    first = decode.snapshot_as_changes(snapshot, "orders", at)
    then = log.filter(F.col("commit_ts") > at - F.expr("INTERVAL 30 DAY"))
    return live(apply_changes(with_meta(first, spec), then, spec))


# -- lake tables and streams -------------------------------------------------------------

_built: dict[tuple[str, str, str], object] = {}


def _once(spark, sf, what, build):
    """Tables written for one query are read by the others of its family in the same application."""
    key = (spark.sparkContext.applicationId, sf, what)
    if key not in _built:
        _built[key] = build()
    return _built[key]


def _lake(spark, sf) -> LakeTable:
    """Inserts, updates, compaction, deletes: versions 1 to 4."""

    def build():
        spec, log = SALES["orders"], fx.order_changes(spark, sf)
        table = LakeTable(spark, scratch_folder(spark, "lake"), spec.schema, spec.key).create()
        for kind in ("INSERT", "UPDATE", "DELETE"):
            table.merge(with_meta(log.filter(F.col("mod_type") == kind), spec), kind)
            if kind == "UPDATE":
                table.compact()
        return table

    return _once(spark, sf, "lake", build)


#: Small row groups, so that the files of a batch are read by many tasks.
FEED_ROW_GROUP = 16 * 1024 * 1024


def _change_files(spark, sf, root: str, records: DataFrame) -> DataFrame:
    """Records in three parts, out of order, as a stream of one part a batch."""
    part = F.pmod(F.xxhash64("data", "seq"), F.lit(3))
    files = [_feed_part(records.filter(part == i), f"{root}/changes", i) for i in range(3)]
    return _feed(spark, f"{root}/changes", max(files))


def _feed_part(rows: DataFrame, folder: str, part: int) -> int:
    """Write a part of a feed after those before it, a file a task; the number of its files."""
    path = f"{folder}/_part={part}"
    rows.write.option("parquet.block.size", FEED_ROW_GROUP).parquet(path)
    return len(rows.sparkSession.read.schema(rows.schema).parquet(path).inputFiles())


def _feed(spark, folder: str, files: int, schema: T.StructType | None = None) -> DataFrame:
    """A stream of a folder's files in the order they were written, so many a batch."""
    options = {"maxFilesPerTrigger": str(files), "recursiveFileLookup": "true"}
    return change_source(spark, "files", folder, *[schema] if schema else [], options=options)


def _backfilled(spark, sf) -> ChangePipeline:
    """The customer log and the inserts first, without marts; then marts are switched on, and the rest of the order log comes."""

    def build():
        root, records = scratch_folder(spark, "late-marts"), _sales_records(spark, sf)
        first = (F.col("table_name") == "customers") | (F.col("mod_type") == "INSERT")
        ChangePipeline(spark, root, SALES).process(records.filter(first), 0)
        pipeline = ChangePipeline(spark, root, SALES, marts=True, thresholds=AT_SCALE)
        for i, kind in enumerate(("UPDATE", "DELETE"), 1):
            pipeline.process(records.filter(~first & (F.col("mod_type") == kind)), i)
        return pipeline

    return _once(spark, sf, "late-marts", build)


def _streamed(spark, sf, marts: bool) -> ChangePipeline:
    """The change log in three files, out of order, streamed one file at a time."""

    def build():
        root = scratch_folder(spark, "stream")
        stream = _change_files(spark, sf, root, _sales_records(spark, sf))
        pipeline = ChangePipeline(spark, root, SALES, marts=marts, thresholds=AT_SCALE)
        pipeline.start(stream, f"{root}/checkpoint", interval=None).awaitTermination()
        return pipeline

    return _once(spark, sf, f"stream-{marts}", build)


@query
def cdc_customers_state(spark, sf):
    return _streamed(spark, sf, marts=False).tables["customers"].read()


@query
def cdc_orders_state(spark, sf):
    return _streamed(spark, sf, marts=False).tables["orders"].read()


@query
def upsert_orders_final(spark, sf):
    spec, log = SALES["orders"], fx.order_changes(spark, sf)
    table = LakeTable(spark, scratch_folder(spark, "upsert"), spec.schema, spec.key).create()
    half = F.pmod(F.xxhash64("id", "seq"), F.lit(2))
    for i in range(2):
        table.merge(with_meta(log.filter(half == i), spec), f"half-{i}")
    return table.read()


@query
def stream_dedup(spark, sf):
    """A log by commit time in four parts, each message again in the next one; the query is stopped half-way and started again."""
    root, log = scratch_folder(spark, "dedup"), fx.order_changes(spark, sf).select("id", "seq", "mod_type", "commit_ts")
    part = F.least(F.floor((F.year("commit_ts") - 1995) / 2), F.lit(3)).cast("int")
    table = LakeTable(spark, f"{root}/once", log.schema, kind="log").create()
    for parts in ((0, 1), (2, 3, 4)):
        files = [_feed_part(log.filter((part == i) | (part == i - 1)), f"{root}/feed", i) for i in parts]
        stream = _feed(spark, f"{root}/feed", max(files), T.StructType([*log.schema.fields]))
        once = without_repeats_within(stream, ["id", "seq"], "commit_ts", "1500 days")
        append_sink(once, table, f"{root}/checkpoint", interval=None).awaitTermination()
    return table.read()


def _retained(spark, sf) -> ChangePipeline:
    """The order log, compacted with tombstones of 300 days kept, then updates from 36 hours after each seventh order came."""

    def build():
        spec, log = SALES["orders"], fx.order_changes(spark, sf)
        pipeline = ChangePipeline(spark, scratch_folder(spark, "retained"), {"orders": spec}, retention="300 days")
        pipeline.process(to_records(log, spec, "analytics"), 0)
        pipeline.tables["orders"].compact()
        late = fx.orders(spark, sf).filter("id % 7 = 0").withColumns(
            {
                "status": F.lit("late"),
                "mod_type": F.lit("UPDATE"),
                "seq": F.lit(9).cast("bigint"),
                "commit_ts": F.expr("created_at + INTERVAL 36 HOURS"),
            }
        )
        pipeline.process(to_records(late, spec, "analytics"), 1)
        return pipeline

    return _once(spark, sf, "retained", build)


@query
def retained_orders_state(spark, sf):
    """Late updates of orders that are there take effect; those of deleted ones don't, whether the delete is still known or not."""
    return _retained(spark, sf).tables["orders"].read()


@query
def retained_tombstones(spark, sf):
    return apply.deleted_keys(_retained(spark, sf).tables["orders"].resolved(), ["id"])


@query
def retention_rejects(spark, sf):
    """Late updates whose orders' deletes are forgotten."""
    rows = _retained(spark, sf).quarantine.read()
    order_id = F.get_json_object("data", "$.id").cast("bigint").alias("id")
    return rows.select("table_name", "reason", order_id, "commit_ts", "seq")


@query
def append_sink_rows(spark, sf):
    """Row images of a topic, streamed and appended once each."""
    root = scratch_folder(spark, "append")
    topic_rows(fx.envelopes(spark, sf)).write.parquet(f"{root}/topic")
    stream = from_envelopes(change_source(spark, "topic_files", f"{root}/topic")).filter("after IS NOT NULL")
    table = LakeTable(spark, f"{root}/sales_raw", T.StructType([T.StructField("after", T.StringType())]), kind="log")
    append_sink(stream.select("after"), table.create(), f"{root}/checkpoint", interval=None).awaitTermination()
    return table.read()


@query
def lake_scan_latest(spark, sf):
    return _lake(spark, sf).read()


@query
def lake_scan_glob(spark, sf):
    """The base layer's files by path pattern: the table as compacted, before the deletes."""
    table = _lake(spark, sf)
    return live(read_glob(spark, f"{table.root}/data/base-*/*/*.parquet", table.stored))


@query
def lake_readback_orders(spark, sf):
    return _lake(spark, sf).read().to(SALES["orders"].schema)


@query
def lake_as_of_version(spark, sf):
    return _lake(spark, sf).read(version=2)


@query
def lake_snapshots(spark, sf):
    rows = _lake(spark, sf).snapshots()
    return rows.select("version", "parent", "operation", "inserted", "updated", "deleted")


@query
def lake_snapshot_summary(spark, sf):
    return _lake(spark, sf).snapshot_summary().select("version", "operation", "inserted", "updated", "deleted")


@query
def lake_files(spark, sf):
    return _lake(spark, sf).files()


@query
def lake_file_rows(spark, sf):
    """Rows per layer, from the data files in force."""
    return _lake(spark, sf).files().groupBy("layer").agg(F.sum("rows").alias("rows"))


# -- exports -----------------------------------------------------------------------------


@query
def export_csv_roundtrip(spark, sf):
    path, rows = scratch_folder(spark, "csv"), fx.customers(spark, sf)
    exports.to_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


@query
def export_json_roundtrip(spark, sf):
    path, rows = scratch_folder(spark, "json"), fx.orders(spark, sf)
    exports.to_json(rows.orderBy(F.desc("amount"), "id"), path)
    return spark.read.schema(rows.schema).json(path)


@query
def export_parquet_roundtrip(spark, sf):
    path = scratch_folder(spark, "parquet")
    rows = adhoc.with_names(fx.customers(spark, sf), fx.orders(spark, sf)).select("name", "amount", "status")
    exports.to_parquet(rows, path)
    return spark.read.schema(rows.schema).parquet(path)


# -- models in full and kept current --------------------------------------------------------


@query
def all_models_counts(spark, sf):
    """Full refresh of every model to saved tables, and their rows."""
    saved = save_models(spark, sources(spark, sf), scratch_folder(spark, "models"), AT_SCALE)
    counts = [
        saved[name].agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("model"), F.lit(MODELS[name].layer).alias("layer"), "row_count"
        )
        for name in run_order()
    ]
    return reduce(DataFrame.unionByName, counts)


def _kept(view: str) -> Query:
    return lambda spark, sf: _streamed(spark, sf, marts=True).marts.read(view)


for _view in (
    "fct_customer_order_summary",
    "dim_customer_spending_tier",
    "fct_order_status_dashboard",
    "fct_daily_order_metrics",
    "fct_high_value_orders",
    "recent_orders",
):
    _add(f"kept_{_view}", _kept(_view))


@query
def full_vs_incremental_diff(spark, sf):
    """Each view as kept current by the stream against the model over the final tables."""
    return _kept_against_full(_streamed(spark, sf, marts=True))


@query
def marts_backfilled(spark, sf):
    """The same for marts that were switched on over filled tables and followed the changes from there."""
    return _kept_against_full(_backfilled(spark, sf))


def _kept_against_full(pipeline: ChangePipeline) -> DataFrame:
    final = {f"{n}_cdc": t.read() for n, t in pipeline.tables.items()}
    full = build_models(final, AT_SCALE)
    full["recent_orders"] = adhoc.recent_orders_top(full["int_customer_orders"], pipeline.marts.keep_recent)
    parts = []
    for name, kept in pipeline.marts.frames().items():
        columns = kept.columns
        key = F.concat_ws("|", *[F.col(k).cast("string") for k in pipeline.marts.views[name].key]).alias("_key")
        ours = kept.select(key, *columns)
        theirs = full[name].select(*[F.col(c).cast(kept.schema[c].dataType).alias(c) for c in columns]).select(key, *columns)
        wrong = quality.differences(ours, theirs, "_key").agg(F.count(F.lit(1)).alias("mismatches"))
        rows = kept.agg(F.count(F.lit(1)).alias("rows"))
        parts.append(
            rows.select(F.lit(name).alias("view"), "rows", wrong.scalar().alias("mismatches"))
        )
    return reduce(DataFrame.unionByName, parts)


# -- quality -----------------------------------------------------------------------------------


@query
def dq_unique(spark, sf):
    return quality.not_unique(fx.faulty_orders(spark, sf), "id")


@query
def dq_not_null(spark, sf):
    return quality.nulls_per_column(fx.faulty_orders(spark, sf), ["id", "customer_id", "amount", "status"])


@query
def dq_relationships(spark, sf):
    bad = quality.orphans(fx.faulty_orders(spark, sf), "customer_id", fx.customers(spark, sf), "id")
    return bad.select("id", "customer_id")


@query
def dq_expression(spark, sf):
    return quality.violations(fx.faulty_orders(spark, sf), "amount >= 5000 AND status <> 'shipped'").select(
        "id", "amount", "status"
    )


@query
def dq_summary(spark, sf):
    """All declared rules over sources with planted faults and the marts built from them."""
    raw = {"customers_cdc": fx.customers(spark, sf), "orders_cdc": fx.faulty_orders(spark, sf)}
    return quality.summary(build_models(raw, AT_SCALE), quality.SALES_RULES)


def _before_and_after(spark, sf):
    log, spec = fx.order_changes(spark, sf), SALES["orders"]
    before = live(apply_changes(None, log.filter("mod_type = 'INSERT'"), spec))
    return before, live(apply_changes(None, log, spec))


@query
def reconcile_counts(spark, sf):
    before, after = _before_and_after(spark, sf)
    return quality.count_by_stage({"source": before, "cdc": after, "sink": _lake(spark, sf).read()})


@query
def reconcile_diff(spark, sf):
    return quality.differences(*_before_and_after(spark, sf), "id")


@query
def reconcile_buckets(spark, sf):
    """The same findings, with checksums of buckets first."""
    return quality.differences_by_bucket(*_before_and_after(spark, sf), "id")


def _kept_rules(spark, sf) -> KeptRules:
    """The source rules, kept from each batch of the change log."""

    def build():
        root, records = scratch_folder(spark, "rules"), _sales_records(spark, sf)
        pipeline = ChangePipeline(spark, root, SALES)
        rules = KeptRules(spark, f"{root}/rules", pipeline.tables, quality.SALES_RULES)
        part = F.pmod(F.xxhash64("data", "seq"), F.lit(3))
        for i in range(3):
            pipeline.process(records.filter(part == i), i)
            rules.catch_up()
        return rules

    return _once(spark, sf, "rules", build)


@query
def kept_dq_summary(spark, sf):
    """Failing counts of the source rules as kept by the batches."""
    return _kept_rules(spark, sf).summary()


@query
def kept_dq_failures(spark, sf):
    """What fails, as kept by the batches: values that are not unique or name nobody, with their rows."""
    return _kept_rules(spark, sf).failing()


@query
def pipeline_latency(spark, sf):
    """Latency with a sink time derived from the row, so that it can be checked."""
    rows = fx.order_changes(spark, sf).withColumn(
        "sink_ts", F.expr("commit_ts + make_dt_interval(0, 0, 0, (id % 100) * 0.05)")
    )
    return quality.latency_summary(
        rows.withColumn("latency_ms", quality.latency_ms("commit_ts", "sink_ts")), ["mod_type"]
    )
