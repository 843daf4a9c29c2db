"""The change scenario by hand, and streams that are shuffled, repeated and restarted."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from changeweir.operators.apply import apply_changes, live, with_meta
from changeweir.operators.decode import accepted, decode_all, to_records
from changeweir.operators import quality
from changeweir.operators.lake import LakeTable
from changeweir.plans import adhoc
from changeweir.plans.models import Thresholds, build_models
from changeweir.schemas import CUSTOMERS, ORDERS, SALES, SHOP
from changeweir.session import scratch_folder
from changeweir.sources import fixtures as fx
from changeweir.sources.feeds import change_source
from changeweir.streaming.pipeline import TOO_LATE, ChangePipeline, append_sink, tumbling_daily_stream, without_repeats_within
from changeweir.streaming.rules import KeptRules

SF = "/root/testdata/sf0.001"


def record(table, mod_type, data, minute, seq=1):
    return (table, mod_type, data, minute, seq)


def records(spark, *events):
    df = spark.createDataFrame(list(events), "table_name STRING, mod_type STRING, data STRING, minute INT, seq BIGINT")
    at = F.expr("TIMESTAMP_NTZ'2025-01-20 00:00:00' + make_dt_interval(0, 0, minute)")
    return df.select(
        "table_name",
        "mod_type",
        "data",
        F.lit(None).cast("string").alias("old_data"),
        at.alias("commit_ts"),
        "seq",
        F.lit(None).cast("string").alias("target_table"),
    )


def customer(i, name, email):
    return f'{{"id":{i},"name":"{name}","email":"{email}"}}'


def order(i, c, date, amount, status):
    return f'{{"id":{i},"customer_id":{c},"order_date":"{date}","amount":{amount},"status":"{status}"}}'


SEED = [
    record("customers", "INSERT", customer(1, "Alice Johnson", "alice@example.com"), 0),
    record("customers", "INSERT", customer(2, "Bob Smith", "bob@example.com"), 0),
    record("customers", "INSERT", customer(3, "Carol White", "carol@example.com"), 0),
    record("orders", "INSERT", order(1, 1, "2025-01-15", "100.50", "completed"), 1),
    record("orders", "INSERT", order(2, 2, "2025-01-16", "250.00", "pending"), 1),
    record("orders", "INSERT", order(3, 1, "2025-01-17", "75.25", "shipped"), 1),
]
CHANGES = [
    record("customers", "INSERT", customer(4, "Demo User", "demo@example.com"), 2),
    record("orders", "INSERT", order(4, 1, "2025-01-20", "99.99", "pending"), 3),
    record("orders", "INSERT", order(5, 2, "2025-01-20", "149.50", "shipped"), 3),
    record("orders", "INSERT", order(6, 1, "2025-01-20", "29.99", "completed"), 3),
    record("orders", "UPDATE", order(1, 1, "2025-01-15", "110.55", "delivered"), 4),
]


def check_scenario(marts):
    got = {
        r.customer_name: (r.order_count, r.total_spent)
        for r in marts.read("fct_customer_order_summary").collect()
    }
    assert got == {
        "Alice Johnson": (4, Decimal("315.78")),
        "Bob Smith": (2, Decimal("399.50")),
        "Carol White": (0, Decimal("0.00")),
        "Demo User": (0, Decimal("0.00")),
    }
    tiers = {r.customer_name: r.customer_tier for r in marts.read("dim_customer_spending_tier").collect()}
    assert tiers == {"Alice Johnson": "Silver", "Bob Smith": "Silver", "Carol White": "Bronze", "Demo User": "Bronze"}
    assert {r.order_id for r in marts.read("fct_high_value_orders").collect()} == {1, 2, 5}
    status = {r.status: r.order_count for r in marts.read("fct_order_status_dashboard").collect()}
    assert status == {"delivered": 1, "pending": 2, "shipped": 2, "completed": 1}


def test_change_scenario(spark):
    pipeline = ChangePipeline(spark, scratch_folder(spark, "scenario"), marts=True)
    pipeline.process(records(spark, *SEED), 0)
    before = {r.status: r.order_count for r in pipeline.marts.read("fct_order_status_dashboard").collect()}
    assert before == {"completed": 1, "pending": 1, "shipped": 1}
    pipeline.process(records(spark, *CHANGES), 1)
    check_scenario(pipeline.marts)
    pipeline.process(records(spark, *CHANGES), 1)  # the batch again, as after a crash
    pipeline.process(records(spark, *SEED, *CHANGES), 2)  # everything delivered once more
    check_scenario(pipeline.marts)

    # An order changes hands, a customer is renamed, one goes, a status empties.
    pipeline.process(
        records(
            spark,
            record("orders", "UPDATE", order(2, 3, "2025-01-16", "250.00", "delivered"), 6),
            record("customers", "UPDATE", customer(1, "Alice J.", "alice@example.com"), 6),
            record("customers", "DELETE", '{"id":4}', 6),
            record("orders", "DELETE", '{"id":4}', 6),
            record("orders", "INSERT", '{"id":7}', 6),
        ),
        3,
    )
    check_equal_to_full(pipeline)
    summary = {r.customer_name: r.order_count for r in pipeline.marts.read("fct_customer_order_summary").collect()}
    assert summary == {"Alice J.": 3, "Bob Smith": 1, "Carol White": 1}
    assert "pending" not in {r.status for r in pipeline.marts.read("fct_order_status_dashboard").collect()}
    assert [r.reason for r in pipeline.quarantine.read().collect()] == [
        "missing customer_id; missing amount"  # the rest has defaults
    ]


def check_equal_to_full(pipeline):
    full = build_models({f"{n}_cdc": t.read() for n, t in pipeline.tables.items()}, pipeline.marts.thresholds)
    full["recent_orders"] = full["recent_orders"].filter(F.col("rank") <= pipeline.marts.keep_recent)
    for name, kept in pipeline.marts.frames().items():
        want = full[name].select(*kept.columns)
        assert kept.exceptAll(want).count() == 0, name
        assert want.exceptAll(kept).count() == 0, name


def test_marts_follow_deletes_and_refills(spark):
    """Fewer kept orders than a customer has: losing one brings the next back."""
    pipeline = ChangePipeline(spark, scratch_folder(spark, "refill"), marts=True, buckets=2, max_deltas=3)
    pipeline.marts.keep_recent = 2
    rows = [record("customers", "INSERT", customer(1, "A", "a@x"), 0)]
    # Created times default to the commit time, one minute apart.
    rows += [record("orders", "INSERT", order(i, 1, "2025-01-15", "10.00", "pending"), i) for i in range(1, 6)]
    pipeline.process(records(spark, *rows), 0)
    assert {r.order_id for r in pipeline.marts.read("recent_orders").collect()} == {5, 4}
    pipeline.process(records(spark, record("orders", "DELETE", '{"id":5}', 10)), 1)
    assert {r.order_id for r in pipeline.marts.read("recent_orders").collect()} == {4, 3}
    for i in range(2, 6):
        new = record("orders", "INSERT", order(10 + i, 1, "2025-01-15", "10.00", "pending"), 10 + i)
        pipeline.process(records(spark, new), i)
    assert {r.order_id for r in pipeline.marts.read("recent_orders").collect()} == {15, 14}
    check_equal_to_full(pipeline)


@pytest.fixture(scope="module")
def change_files(spark):
    """The order log as single files: hashed apart, so out of order, and one of them twice."""
    root = scratch_folder(spark, "files")
    log = to_records(fx.order_changes(spark, SF), ORDERS, "s")
    for i in range(4):
        part = log.filter(F.pmod(F.xxhash64("data", "seq"), F.lit(4)) == i)
        part.coalesce(1).write.mode("append").parquet(f"{root}/first" if i < 2 else f"{root}/second")
    log.filter(F.pmod(F.xxhash64("data", "seq"), F.lit(4)) == 0).coalesce(1).write.mode("append").parquet(
        f"{root}/second"
    )
    return root


def test_stream_restarts_where_it_stopped(spark, change_files):
    root = scratch_folder(spark, "restart")
    feed = f"{root}/feed"
    spark.read.parquet(f"{change_files}/first").repartition(2).write.parquet(feed)

    def run():
        pipeline = ChangePipeline(spark, root, {"orders": ORDERS})
        stream = change_source(spark, "files", feed, options={"maxFilesPerTrigger": "1"})
        query = pipeline.start(stream, f"{root}/checkpoint", interval=None)
        query.awaitTermination()
        return pipeline

    run()
    versions = run().tables["orders"].latest().version
    assert versions == run().tables["orders"].latest().version  # nothing new, nothing done
    spark.read.parquet(f"{change_files}/second").repartition(2).write.mode("append").parquet(feed)
    pipeline = run()
    want = live(apply_changes(None, fx.order_changes(spark, SF), ORDERS))
    got = pipeline.tables["orders"].read()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
    assert pipeline.quarantine.read().count() == 0


def test_interval_trigger_keeps_up(spark):
    root = scratch_folder(spark, "tail")
    feed = f"{root}/feed"
    records(spark, *SEED).write.parquet(feed)
    pipeline = ChangePipeline(spark, root, SALES)
    query = pipeline.start(change_source(spark, "files", feed), f"{root}/checkpoint", interval="1 second")
    try:
        query.processAllAvailable()
        records(spark, *CHANGES).write.mode("append").parquet(feed)
        query.processAllAvailable()
    finally:
        query.stop()
    assert pipeline.tables["customers"].read().count() == 4
    assert pipeline.tables["orders"].read().count() == 6


def test_snapshot_then_stream_to_three_tables(spark):
    """Snapshots first, skipped when done; then changes fan out to the tables, with latency noted."""
    pipeline = ChangePipeline(spark, scratch_folder(spark, "shop"), SHOP, metrics=True)
    at = F.expr("TIMESTAMP_NTZ'2025-01-20 00:05:00'")
    shop = {
        "customers": fx.shop_customers(spark, SF).filter("customer_id < 5"),
        "products": fx.shop_products(spark, SF).filter("product_id < 5"),
        "orders": fx.shop_orders(spark, SF).filter("order_id < 3"),
    }
    assert pipeline.snapshot({"customers": shop["customers"]}, at) == ["customers"]
    assert pipeline.snapshot(shop, at) == ["products", "orders"]
    assert pipeline.snapshot(shop, at) == []
    pipeline.process(
        records(
            spark,
            record("customers", "UPDATE", '{"customer_id":1,"name":"early"}', 1),  # older than the snapshot
            record("customers", "UPDATE", '{"customer_id":2,"name":"later"}', 9),
            record("products", "DELETE", '{"product_id":3}', 9),
            record("orders", "INSERT", '{"order_id":9,"customer_id":1,"product_id":1,"total_amount":5}', 9),
            record("orders", "INSERT", '{"order_id":10,"customer_id":1}', 9),
            record("suppliers", "INSERT", '{"id":1}', 9),
        ),
        0,
    )
    names = {r.customer_id: r.name for r in pipeline.tables["customers"].read().collect()}
    assert names[1] == "Customer#000000001" and names[2] == "later"
    assert {r.product_id for r in pipeline.tables["products"].read().collect()} == {0, 1, 2, 4}
    assert {r.order_id for r in pipeline.tables["orders"].read().collect()} == {0, 1, 2, 9}
    reasons = {(r.table_name, r.reason) for r in pipeline.quarantine.read().collect()}
    assert reasons == {("orders", "missing product_id"), ("suppliers", "unknown table")}
    noted = {r.table_name: (r.batch, r.n) for r in pipeline.metrics.read().collect()}
    assert noted == {"customers": ("batch-0", 1), "products": ("batch-0", 1), "orders": ("batch-0", 1)}


def test_marts_start_from_a_snapshot(spark):
    pipeline = ChangePipeline(spark, scratch_folder(spark, "start"), marts=True)
    at = F.expr("TIMESTAMP_NTZ'1996-01-01 00:00:00'")
    tables = {"customers": fx.customers(spark, SF), "orders": fx.orders(spark, SF)}
    pipeline.snapshot(tables, at)
    check_equal_to_full(pipeline)
    pipeline.snapshot(tables, at)  # a restart
    gone = record("orders", "DELETE", '{"id":1}', 0)
    pipeline.process(records(spark, gone), 0)
    check_equal_to_full(pipeline)


def test_append_sink_writes_each_batch_once(spark):
    root = scratch_folder(spark, "append")
    table = LakeTable(spark, f"{root}/t", CUSTOMERS.schema, kind="log").create()
    fx.customers(spark, SF).repartition(3).write.parquet(f"{root}/in")
    stream = change_source(spark, "files", f"{root}/in", CUSTOMERS.schema, {"maxFilesPerTrigger": "1"})
    append_sink(stream, table, f"{root}/c", interval=None).awaitTermination()
    table.append(fx.customers(spark, SF), "batch-0")  # a replay
    assert table.read().count() == fx.customers(spark, SF).count()


def test_complete_days_are_emitted(spark):
    root = scratch_folder(spark, "windows")
    orders = fx.orders(spark, SF)
    orders.orderBy("created_at").coalesce(1).write.parquet(f"{root}/in")
    stream = tumbling_daily_stream(change_source(spark, "files", f"{root}/in", orders.schema))
    query = (
        stream.writeStream.format("memory").queryName("days").outputMode("append")
        .option("checkpointLocation", f"{root}/c").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("days")
    want = adhoc.tumbling_daily(orders)
    last = want.agg(F.max("window_end")).head()[0]
    complete = want.filter(F.col("window_end") < F.lit(last) - F.expr("INTERVAL 1 DAY"))
    assert got.exceptAll(want).count() == 0
    assert complete.exceptAll(got).count() == 0


def test_mart_keeps_an_order_that_moved_when_its_old_owner_changes(spark):
    """The order lives under its new customer; a later change of the old one must not take it away."""
    root = scratch_folder(spark, "moved")
    pipeline = ChangePipeline(spark, root, marts=True)
    order = '{"id":1,"customer_id":%d,"order_date":"2025-01-15","amount":"300.00","status":"pending"}'
    customer = '{"id":%d,"name":"%s","email":"a@b.example"}'
    steps = [
        [("customers", "INSERT", customer % (1, "one")), ("customers", "INSERT", customer % (2, "two")), ("orders", "INSERT", order % 1)],
        [("orders", "UPDATE", order % 2)],
        [("customers", "UPDATE", customer % (1, "uno"))],
    ]
    for n, step in enumerate(steps):
        rows = [(t, m, d, None, 10 * n + i) for i, (t, m, d) in enumerate(step)]
        batch = spark.createDataFrame(rows, "table_name STRING, mod_type STRING, data STRING, old_data STRING, seq BIGINT")
        pipeline.process(batch.withColumn("commit_ts", F.expr(f"TIMESTAMP_NTZ'2025-01-0{n + 1} 00:00:00'")), n)
    kept = pipeline.marts.read("fct_high_value_orders").collect()
    assert [(r.order_id, r.customer_name) for r in kept] == [(1, "two")]


def test_snapshot_is_taken_after_the_stream_has_written_other_tables(spark):
    pipeline = ChangePipeline(spark, scratch_folder(spark, "late-snapshot"))
    row = ("customers", "INSERT", '{"id":1,"name":"one","email":"a@b.example"}', None, 1)
    batch = spark.createDataFrame([row], "table_name STRING, mod_type STRING, data STRING, old_data STRING, seq BIGINT")
    pipeline.process(batch.withColumn("commit_ts", F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'")), 0)
    orders = spark.sql(
        "SELECT 7L AS id, 1L AS customer_id, DATE'2025-01-01' AS order_date, CAST(5 AS DECIMAL(10,2)) AS amount,"
        " 'pending' AS status, TIMESTAMP_NTZ'2025-01-01 00:00:00' AS created_at"
    )
    at = F.expr("TIMESTAMP_NTZ'2024-12-31 00:00:00'")
    assert pipeline.snapshot({"orders": orders}, at) == ["orders"]
    assert [r.id for r in pipeline.tables["orders"].read().collect()] == [7]
    assert pipeline.snapshot({"orders": orders}, at) == []


def test_old_batches_stay_known(spark, monkeypatch):
    from changeweir.operators import lake

    monkeypatch.setattr(lake, "REMEMBERED", 2)
    table = lake.LakeTable(spark, scratch_folder(spark, "replay"), spark.range(0).withColumnRenamed("id", "x").schema, kind="log").create()
    for n in range(5):
        table.append(spark.range(1).withColumnRenamed("id", "x"), f"batch-{n}")
    table.append(spark.range(1).withColumnRenamed("id", "x"), "batch-0")
    assert table.read().count() == 5


def test_marts_switched_on_over_filled_tables(spark):
    """Backfilled at a version, then followed; also when the backfill is cut short, and when marts were off for a while."""
    root = scratch_folder(spark, "late")
    ChangePipeline(spark, root).process(records(spark, *SEED), 0)
    pipeline = ChangePipeline(spark, root, marts=True)
    assert pipeline.marts.position() is None

    def broken(*args):
        raise RuntimeError("lost")

    # Cut short: one table of the backfill can't be written the first time.
    put = pipeline.marts.orders_by_customer.put
    pipeline.marts.orders_by_customer.put = broken
    with pytest.raises(RuntimeError):
        pipeline.marts.catch_up()
    pipeline.marts.orders_by_customer.put = put
    assert pipeline.marts.position() is None
    # Something is merged before it goes on; it goes on at the version that it began with.
    without = ChangePipeline(spark, root)
    without.process(records(spark, *CHANGES[:2]), 1)
    pipeline = ChangePipeline(spark, root, marts=True)
    pipeline.process(records(spark, *CHANGES[2:]), 2)
    check_scenario(pipeline.marts)
    check_equal_to_full(pipeline)
    # Off for two batches, one of them customers only, then on again.
    without = ChangePipeline(spark, root)
    without.process(records(spark, record("customers", "UPDATE", customer(1, "Alice J.", "alice@example.com"), 7)), 3)
    without.process(records(spark, record("orders", "DELETE", '{"id":1}', 8), record("customers", "DELETE", '{"id":3}', 8)), 4)
    pipeline = ChangePipeline(spark, root, marts=True)
    pipeline.marts.catch_up()
    check_equal_to_full(pipeline)
    pipeline.process(records(spark, record("orders", "DELETE", '{"id":1}', 8)), 4)  # a batch again
    check_equal_to_full(pipeline)
    summary = {r.customer_name: r.order_count for r in pipeline.marts.read("fct_customer_order_summary").collect()}
    assert summary["Alice J."] == 3


def test_inserts_get_declared_defaults(spark):
    pipeline = ChangePipeline(spark, scratch_folder(spark, "defaults"))
    insert = '{"id":1,"customer_id":1,"amount":5}'
    pipeline.process(records(spark, record("orders", "INSERT", insert, 3), record("orders", "UPDATE", insert.replace("1,", "2,", 1), 3)), 0)
    (row,) = pipeline.tables["orders"].read().collect()
    assert (row.status, str(row.order_date), row.created_at.minute) == ("pending", "2025-01-20", 3)
    assert [r.reason for r in pipeline.quarantine.read().collect()] == ["missing order_date; missing status"]


def test_repeats_within_the_delay_are_dropped(spark):
    """State is as long as the delay: a repeat inside is dropped, and so is what comes later than that."""
    root = scratch_folder(spark, "repeats")
    table = LakeTable(spark, f"{root}/once", CUSTOMERS.schema, kind="log").create()

    def deliver(*days):
        at = [(d, "n", "e", d) for d in days]
        rows = spark.createDataFrame(at, "id BIGINT, name STRING, email STRING, d INT")
        rows = rows.selectExpr("id", "name", "email", "TIMESTAMP_NTZ'2025-01-01 00:00:00' + make_dt_interval(d) AS created_at")
        rows.coalesce(1).write.mode("append").parquet(f"{root}/in")
        stream = change_source(spark, "files", f"{root}/in", CUSTOMERS.schema)
        once = without_repeats_within(stream, ["id"], "created_at", "5 days")
        append_sink(once, table, f"{root}/c", interval=None).awaitTermination()
        return sorted(r.id for r in table.read().collect())

    assert deliver(1, 2, 2) == [1, 2]
    assert deliver(2, 3) == [1, 2, 3]
    assert deliver(1, 20) == [1, 2, 3, 20]
    assert deliver(2, 21) == [1, 2, 3, 20, 21]


def test_rules_follow_the_batches(spark):
    """Kept counts equal the rules over the tables after each batch, when values stop failing too."""
    root = scratch_folder(spark, "rules")
    pipeline = ChangePipeline(spark, root, max_deltas=2)
    rules = KeptRules(spark, f"{root}/rules", pipeline.tables, quality.SALES_RULES, max_deltas=2)
    batches = [
        [*SEED, record("orders", "INSERT", order(9, 77, "2025-01-20", "1.00", "pending"), 1)],
        [record("customers", "INSERT", customer(5, "Al", "alice@example.com"), 5), record("customers", "DELETE", '{"id":2}', 5)],
        [record("customers", "INSERT", customer(77, "Late", "late@example.com"), 6), record("customers", "UPDATE", customer(5, "Al", "al@x"), 6)],
        [record("orders", "DELETE", '{"id":2}', 7)],
    ]
    for i, batch in enumerate(batches):
        pipeline.process(records(spark, *batch), i)
        rules.catch_up()
        rules.catch_up()
        frames = {f"{n}_cdc": t.read() for n, t in pipeline.tables.items()}
        frames = build_models(frames, pipeline.marts.thresholds if pipeline.marts else Thresholds())
        want = {r.rule: r.n_failed for r in quality.summary(frames, rules.rules).collect()}
        assert {r.rule: r.n_failed for r in rules.summary().collect()} == want
    assert sum(want.values()) == 0


def _at(day, *events):
    """Events of order 1.. as (table, type, data, minute, seq), minutes counted from a day on."""
    return [record(t, m, d, 1440 * day + minute, seq) for t, m, d, minute, seq in events]


def test_retention_keeps_new_tombstones_and_sets_late_changes_aside(spark):
    def orders(day, kind, *ids, seq=1):
        return _at(day, *[record("orders", kind, order(i, 1, "2025-01-15", "10.00", f"{kind}-{day}"), 0, seq) for i in ids])

    root = scratch_folder(spark, "retention")
    pipeline = ChangePipeline(spark, root, {"orders": ORDERS}, marts=False, retention="10 days")
    first = orders(0, "INSERT", 1, 2, 3) + orders(1, "DELETE", 1) + orders(20, "DELETE", 2) + orders(25, "INSERT", 4)
    pipeline.process(records(spark, *first), 0)
    table = pipeline.tables["orders"]
    before = table.latest().version
    assert table.undecided(table.resolved(), "batch-x").count() == 0  # no horizon yet
    table.compact()
    assert table.latest().horizon == "2025-02-04 00:00:00"  # day 25 less ten
    assert {r.id for r in table.resolved().filter("_op = 'DELETE'").collect()} == {2}  # 1 is forgotten
    assert {r.id for r in table.read().collect()} == {3, 4} == {r.id for r in table.read(before).collect()}

    late = records(
        spark,
        *orders(2, "UPDATE", 1, seq=2),  # the delete of day 1 is forgotten: can't be told
        *orders(3, "UPDATE", 1, seq=3),  # and again: the newest of a key speaks for it
        *orders(2, "UPDATE", 2, 3, seq=2),  # 2 is known to be deleted later; 3 is there
        *orders(2, "INSERT", 5),  # never seen, as far as can be told
        *orders(16, "INSERT", 6),  # never seen, within the retention
        *orders(2, "UPDATE", 7) + orders(26, "INSERT", 7),  # its newest change is within
    )
    for _ in range(2):  # delivered again after a restart: nothing changes
        again = ChangePipeline(spark, root, {"orders": ORDERS}, retention="10 days")
        again.process(late, 1)
        kept = {r.id: r.status for r in again.tables["orders"].read().collect()}
        assert kept == {3: "UPDATE-2", 4: "INSERT-25", 6: "INSERT-16", 7: "INSERT-26"}
        aside = again.quarantine.read().collect()
        assert sorted((r.reason, r.seq, r.commit_ts.day) for r in aside) == [(TOO_LATE, 1, 22), (TOO_LATE, 3, 23)]
    # A replay that finds the tables merged and the quarantine not written names the same rows.
    changes = again.tables["orders"].undecided(with_meta(accepted(decode_all(late, {"orders": ORDERS})["orders"], ORDERS), ORDERS), "batch-1")
    assert {r.id for r in changes.collect()} == {1, 5}

    # A snapshot that comes after all that is judged alike; the horizon outlives other commits and never goes back.
    snapshot = again.tables["orders"].read().filter("id = 4").withColumn("id", F.lit(9).cast("bigint"))
    again.snapshot({"orders": snapshot}, F.expr("TIMESTAMP_NTZ'2025-01-21 00:00:00'"))
    assert again.quarantine.read().count() == 3 and again.tables["orders"].read().count() == 4
    longer = LakeTable(spark, again.tables["orders"].root, ORDERS.schema, ORDERS.key, retention="1000 days")
    longer.compact()
    assert longer.latest().horizon == "2025-02-04 00:00:00"
    assert longer.latest().newest == "2025-02-15 00:00:00"


def test_marts_follow_tables_with_a_retention(spark):
    root = scratch_folder(spark, "retention-marts")
    pipeline = ChangePipeline(spark, root, SALES, marts=True, retention="1 minute", max_deltas=1)
    for i, events in enumerate((SEED, CHANGES, [record("orders", "UPDATE", order(2, 2, "2025-01-16", "1.00", "late"), 1, 9)])):
        pipeline.process(records(spark, *events), i)
        for table in pipeline.tables.values():
            table.compact()
    models = build_models({f"{n}_cdc": t.read() for n, t in pipeline.tables.items()}, Thresholds(), ["fct_customer_order_summary"])
    full = models["fct_customer_order_summary"]
    kept = pipeline.marts.read("fct_customer_order_summary").select(*full.columns)
    assert kept.exceptAll(full).count() == full.exceptAll(kept).count() == 0


def test_a_batch_of_a_feed_lies_in_many_files(spark):
    """Parts follow each other as batches; each is written, and so can be read, by more than one task."""
    from changeweir.plans.registry import _change_files, _feed_part

    root, spec = scratch_folder(spark, "feed"), SALES["orders"]
    rows = to_records(fx.order_changes(spark, SF), spec, "analytics").drop("target_table").repartition(4)
    stream, seen = _change_files(spark, SF, root, rows), []
    at = stream.writeStream.foreachBatch(lambda df, i: seen.append((len(df.inputFiles()), df.count())) and None)
    at.option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start().awaitTermination()
    assert len(seen) == 3 and sum(n for _, n in seen) == rows.count()
    parts = spark.read.parquet(f"{root}/changes").selectExpr("_part", "_metadata.file_path AS f")
    assert {r.n for r in parts.groupBy("_part").agg(F.countDistinct("f").alias("n")).collect()} == {4}
    assert _feed_part(rows, f"{root}/more", 0) == 4
