import pytest

from changeweir.operators import quality
from changeweir.plans import adhoc
from changeweir.plans.models import MODELS, run_order
from changeweir.plans.registry import QUERIES, one_model
from changeweir.session import scratch_folder
from changeweir.sources import exports
from changeweir.sources import fixtures as fx
from changeweir.sources.feeds import change_source

SF = "/root/testdata/sf0.001"


@pytest.fixture
def shop(spark):
    customers = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b"), (3, None)], "id BIGINT, email STRING")
    orders = spark.createDataFrame(
        [(1, 1, 50), (2, 9, None), (3, None, 200), (4, 9, 500)], "id BIGINT, customer_id BIGINT, amount INT"
    )
    return {"customers": customers, "orders": orders}


RULES = (
    quality.Rule("customers", "unique", "id"),
    quality.Rule("customers", "not_null", "email"),
    quality.Rule("orders", "relationships", "customer_id", ("customers", "id")),
    quality.Rule("orders", "expression", "", "amount >= 100"),
)


def test_planted_violations(spark, shop):
    got = {r.rule: r.n_failed for r in quality.summary(shop, RULES).collect()}
    assert got == {
        "unique_customers_id": 1,
        "not_null_customers_email": 1,
        "relationships_orders_customer_id": 2,
        "expression_orders": 2,  # 50, and the unknown one
    }
    saved = quality.store_failures(spark, shop, RULES, scratch_folder(spark, "failures"))
    assert {n: df.count() for n, df in saved.items()} == got
    assert {r.id for r in saved["relationships_orders_customer_id"].collect()} == {2, 4}


def test_differences(spark, rows):
    left = spark.createDataFrame([(1, "a"), (2, None), (3, "c"), (5, None)], "id BIGINT, v STRING")
    right = spark.createDataFrame([(1, "a"), (2, "x"), (4, "d"), (5, None)], "id BIGINT, v STRING")
    assert rows(quality.differences(left, right, "id")) == [(2, "changed"), (3, "only_left"), (4, "only_right")]


def test_anti_join_forms_agree(spark, rows):
    c, o = fx.customers(spark, SF), fx.orders(spark, SF)
    by_null = c.join(o.withColumnRenamed("id", "oid"), c["id"] == o["customer_id"], "left").filter("oid IS NULL")
    assert rows(adhoc.customers_without_orders(c, o), "name") == rows(by_null, "name")


def test_random_sample(spark):
    c = fx.customers(spark, SF)
    sample = adhoc.random_rows(c, 5, "id", seed=1)
    assert sample.count() == 5
    assert sample.exceptAll(c).count() == 0


def test_models_run_after_what_they_need():
    order = run_order()
    assert set(order) == set(MODELS)
    for name in order:
        assert all(order.index(d) < order.index(name) for d in MODELS[name].needs if d in MODELS)
    assert run_order(["dim_customer_spending_tier"])[-2:] == ["fct_customer_order_summary", "dim_customer_spending_tier"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_the_scan(spark):
    text = plan(one_model(spark, SF, "fct_customer_order_summary"))
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in text


def test_no_query_uses_a_cross_join(spark):
    # Streams and written tables have their own plans; these are the pure queries.
    skipped = ("cdc_", "kept_", "lake_", "export_", "append_", "upsert_", "full_vs", "all_models")
    for name, fn in QUERIES.items():
        if not name.startswith(skipped):
            text = plan(fn(spark, SF))
            assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name


def test_upsert_statements():
    delete, insert = exports.jdbc_upsert_sql("orders_sink", "orders_sink_staging", ["id"], ["id", "amount"])
    assert "s._op = 'DELETE'" in delete
    assert insert.endswith("ON CONFLICT (id) DO UPDATE SET amount = EXCLUDED.amount")
    (merge,) = exports.jdbc_upsert_sql("t", "s_t", ["id"], ["id", "amount"], "merge")
    assert merge.startswith("MERGE INTO t t USING s_t s ON t.id = s.id")
    with pytest.raises(ValueError):
        exports.jdbc_upsert_sql("t", "s", ["id"], ["id"], "other")
    guarded = ["id", "amount", "ts", "seq"]
    delete, insert = exports.jdbc_upsert_sql("t", "s", ["id"], guarded, version=["ts", "seq"])
    assert delete.endswith("s._op = 'DELETE' AND (t.ts, t.seq) < (s.ts, s.seq)")
    assert insert.endswith("seq = EXCLUDED.seq WHERE (t.ts, t.seq) < (EXCLUDED.ts, EXCLUDED.seq)")
    (merge,) = exports.jdbc_upsert_sql("t", "s", ["id"], guarded, "merge", ["ts", "seq"])
    assert "AND (t.ts < s.ts OR t.ts = s.ts AND t.seq < s.seq) THEN UPDATE SET" in merge


def test_unknown_source_kind(spark):
    with pytest.raises(ValueError):
        change_source(spark, "carrier pigeon", "x")


def test_bucket_checksums_lead_to_the_differences(spark, rows):
    left = spark.range(1000).selectExpr("id", "id % 7 AS a", "IF(id % 5 = 0, NULL, id) AS b")
    right = spark.range(3, 1002).selectExpr("IF(id % 5 = 0, NULL, id) AS b", "id", "IF(id = 500, 9, id % 7) AS a")
    found = quality.differing_buckets(left, right, ["id"], 256)
    assert 2 <= found.count() <= 6  # 0, 1, 2, 500, 1000, 1001
    want = rows(quality.differences(left, right.select("id", "a", "b"), "id"))
    assert rows(quality.differences_by_bucket(left, right, "id", 256)) == want and len(want) == 6
    assert quality.differences_by_bucket(left, left, "id").count() == 0


def test_samples_merge(spark):
    """The sample of a whole is the sample of its parts' samples."""
    df = spark.range(500)
    whole = {r.id for r in adhoc.random_rows(df, 9, "id", seed=3).collect()}
    parts = [adhoc.random_rows(df.filter(f"id % 3 = {i}"), 9, "id", seed=3) for i in range(3)]
    assert {r.id for r in adhoc.random_rows(parts[0].union(parts[1]).union(parts[2]), 9, "id", seed=3).collect()} == whole
    assert whole != {r.id for r in adhoc.random_rows(df, 9, "id", seed=4).collect()}


def test_latency_percentiles_are_exact(spark):
    from pyspark.sql import functions as F

    n = 300_001
    ms = (F.col("id") * 7919 % n - 1000).alias("latency_ms")  # -1000 to 299,000, each once
    rows = spark.range(n).select(F.lit("t").alias("g"), ms).unionByName(
        spark.sql("SELECT 'none' AS g, CAST(NULL AS BIGINT) AS latency_ms")
    )
    got = {r.g: tuple(r)[1:] for r in quality.latency_summary(rows, ["g"]).collect()}
    place = lambda q: -(-n * q // 100) - 1 - 1000
    assert got["t"] == (n, 149_000.0, place(50), place(95), place(99), n - 1001)
    assert got["none"] == (0, None, None, None, None, None)
