import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeweir.operators.apply import apply_changes, live, with_meta
from changeweir.operators.lake import LakeTable, iceberg_merge_sql
from changeweir.schemas import CUSTOMERS
from changeweir.session import scratch_folder

FIELDS = "mod_type STRING, seq BIGINT, id BIGINT, name STRING, email STRING, created_at TIMESTAMP_NTZ, commit_ts TIMESTAMP_NTZ"


def change(spark, *events):
    """Events ``(mod_type, id, name, hour)``."""
    data = [(m, 100 + h, i, n, f"{n}@x") for m, i, n, h in events]
    df = spark.createDataFrame(data, "mod_type STRING, seq BIGINT, id BIGINT, name STRING, email STRING")
    at = F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00' + make_dt_interval(0, int(seq) - 100)")
    return df.withColumn("created_at", at).withColumn("commit_ts", at)


@pytest.fixture
def table(spark):
    return LakeTable(spark, scratch_folder(spark, "t"), CUSTOMERS.schema, CUSTOMERS.key, buckets=4).create()


def names(df):
    return {r.id: r.name for r in df.collect()}


def merge(spark, table, batch_id, *events):
    return table.merge(with_meta(change(spark, *events), CUSTOMERS), batch_id)


def test_insert_update_delete_and_versions(spark, table):
    assert table.read().count() == 0
    first = merge(spark, table, "a", ("INSERT", 1, "x", 0), ("INSERT", 2, "y", 0))
    second = merge(spark, table, "b", ("UPDATE", 1, "z", 1), ("DELETE", 2, "y", 1), ("INSERT", 3, "w", 1))
    assert first.counts == {"inserted": 2, "updated": 0, "deleted": 0, "rows": 2}
    assert second.counts == {"inserted": 1, "updated": 1, "deleted": 1, "rows": 3}
    assert names(table.read()) == {1: "z", 3: "w"}
    assert names(table.read(first.version)) == {1: "x", 2: "y"}
    assert table.read(0).count() == 0
    with pytest.raises(ValueError):
        table.read(99)
    ops = [(r.version, r.operation, r.deleted) for r in table.snapshots().orderBy("version").collect()]
    assert ops == [(0, "create", 0), (1, "merge", 0), (2, "merge", 1)]


def test_a_batch_commits_once(spark, table):
    merge(spark, table, "a", ("INSERT", 1, "x", 0))
    again = merge(spark, table, "a", ("INSERT", 1, "changed", 5))
    assert again.version == 1
    assert names(table.read()) == {1: "x"}


def test_late_changes_do_not_undo_later_ones(spark, table):
    merge(spark, table, "a", ("DELETE", 1, "x", 5), ("INSERT", 2, "new", 5))
    late = merge(spark, table, "b", ("UPDATE", 1, "zombie", 3), ("INSERT", 2, "old", 1))
    assert late.counts["rows"] == 0
    assert names(table.read()) == {2: "new"}
    merge(spark, table, "c", ("INSERT", 1, "back", 6))
    assert names(table.read()) == {1: "back", 2: "new"}


def test_compaction_changes_nothing_but_layers(spark, table):
    merge(spark, table, "a", ("INSERT", 1, "x", 0), ("INSERT", 2, "y", 0))
    merge(spark, table, "b", ("DELETE", 2, "y", 1))
    before = names(table.read())
    table.compact()
    assert names(table.read()) == before
    merge(spark, table, "c", ("UPDATE", 2, "zombie", 0), ("UPDATE", 1, "late", 2))
    assert names(table.read()) == {1: "late"}
    assert {r.layer for r in table.files().collect()} == {"base", "delta"}
    assert sum(r.rows for r in table.files().collect()) == 3


def test_lookup_opens_touched_buckets_only(spark, table):
    merge(spark, table, "a", *[("INSERT", i, f"n{i}", 0) for i in range(50)])
    table.compact()
    found = table.lookup(spark.createDataFrame([(7,), (7,), (99,)], "id BIGINT"))
    assert [(r.id, r.name) for r in found.collect()] == [(7, "n7")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_bucket" in plan or "PartitionFilters: [isnotnull(_bucket" in plan


@pytest.mark.parametrize("seed", range(3))
def test_random_log_in_any_batches(spark, seed):
    """Shuffled arrival, repeats, replays and compactions end where one batch ends."""
    rng = random.Random(seed)
    log = []
    for key in range(25):
        for n in range(rng.randint(1, 5)):
            log.append((rng.choice(["INSERT", "UPDATE", "DELETE"]), key, f"k{key}v{n}", n))
    want = names(live(apply_changes(None, change(spark, *log), CUSTOMERS)))
    delivered = log + rng.sample(log, 10)
    rng.shuffle(delivered)
    table = LakeTable(
        spark, scratch_folder(spark, "r"), CUSTOMERS.schema, CUSTOMERS.key, buckets=3, max_deltas=2
    ).create()
    size = len(delivered) // 4 + 1
    for i in range(4):
        part = delivered[i * size : (i + 1) * size]
        merge(spark, table, f"b{i}", *part)
        if rng.random() < 0.5:
            merge(spark, table, f"b{i}", *part)
    assert names(table.read()) == want


def test_shuffled_read_equals_broadcast_read(spark, table, monkeypatch):
    merge(spark, table, "a", *[("INSERT", i, "x", 0) for i in range(20)])
    table.compact()
    merge(spark, table, "b", *[("UPDATE", i, "y", 1) for i in range(5)], ("DELETE", 9, "x", 1))
    want = names(table.read())
    monkeypatch.setattr("changeweir.operators.lake.BROADCAST_BYTES", 0)
    monkeypatch.setattr("changeweir.operators.lake.BROADCAST_KEYS", 0)
    assert names(table.read()) == want
    assert table.lookup(spark.createDataFrame([(3,)], "id BIGINT")).head().name == "y"


def test_sums_add_up_and_take_back(spark):
    schema = T.StructType(
        [
            T.StructField("k", T.StringType()),
            T.StructField("n", T.LongType()),
            T.StructField("total", T.DecimalType(20, 2)),
        ]
    )
    table = LakeTable(spark, scratch_folder(spark, "s"), schema, ["k"], kind="sums", buckets=2).create()
    rows = [("a", 1, Decimal("2.50")), (None, 1, Decimal("1.00"))]
    table.append(spark.createDataFrame(rows, schema), "1")
    table.append(spark.createDataFrame([("a", -1, Decimal("-2.50")), ("b", 2, Decimal("4.00"))], schema), "2")
    table.append(spark.createDataFrame([("b", 5, Decimal("1.00"))], schema), "2")  # replay
    want = {("a", 0, Decimal("0.00")), ("b", 2, Decimal("4.00")), (None, 1, Decimal("1.00"))}
    assert {tuple(r) for r in table.read().collect()} == want
    table.compact()
    assert {tuple(r) for r in table.read().collect()} == want
    null_key = spark.createDataFrame([(None,)], "k STRING")
    assert table.lookup(null_key).collect()[0].n == 1


def test_two_writers_do_not_share_a_version(spark, table):
    stale = table.latest()
    merge(spark, table, "a", ("INSERT", 1, "x", 0))
    with pytest.raises(RuntimeError, match="another writer"):
        table._publish(stale, "other", "merge", [], {})


def test_many_small_batches_fold(spark):
    """The number of layers stays small and the base is not rewritten for each."""
    table = LakeTable(
        spark, scratch_folder(spark, "fold"), CUSTOMERS.schema, CUSTOMERS.key, buckets=2, max_deltas=3
    ).create()
    merge(spark, table, "big", *[("INSERT", i, f"n{i}" * 20, 0) for i in range(5000)])
    base = table.compact().layers[0]
    for i in range(9):
        merge(spark, table, f"b{i}", ("UPDATE", i, f"new{i}", 1), ("DELETE", 100 + i, "x", 1))
    layers = table.latest().layers
    assert base in layers and len(layers) <= 5
    got = names(table.read())
    assert len(got) == 4991 and got[3] == "new3" and got[50] == "n50" * 20
    assert "fold" in {r.operation for r in table.snapshots().collect()}


def test_log_tables_fold(spark):
    table = LakeTable(spark, scratch_folder(spark, "log"), CUSTOMERS.schema, kind="log", max_deltas=2).create()
    rows = change(spark, ("INSERT", 1, "x", 0)).select(*CUSTOMERS.columns)
    for i in range(6):
        table.append(rows, f"b{i}")
        table.append(rows, f"b{i}")
    assert table.read().count() == 6
    assert len(table.latest().layers) <= 3


def test_a_lost_hint_is_found_again(spark, table):
    merge(spark, table, "a", ("INSERT", 1, "x", 0))
    table.folder.write("_commits/hint", "0")
    assert table.latest().version == 1
    table.folder.write("_commits/hint", "")
    assert table.latest().version == 1


def test_merge_statement():
    sql = iceberg_merge_sql("lake.orders", "batch", ["id"], ["id", "amount"])
    newer = "WHEN MATCHED AND (s._commit_ts > t._commit_ts OR (s._commit_ts = t._commit_ts AND s._seq > t._seq)) THEN UPDATE"
    assert f"{newer} SET t.amount = s.amount, t._op = s._op" in sql


def test_a_bucket_is_written_by_as_many_tasks_as_it_needs(spark):
    """One bucket, and tasks of 16 kB: the base has several files, and the same rows."""
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType())])
    table = LakeTable(spark, scratch_folder(spark, "wide"), schema, ["id"], buckets=1)
    rows = spark.range(20_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("name"))
    had = {k: spark.conf.get(k) for k in small}
    try:
        for k, v in small.items():
            spark.conf.set(k, v)
        table.put(rows.withColumn("_op", F.lit("PUT")), "all", 1)
        table.compact()
    finally:
        for k, v in had.items():
            spark.conf.set(k, v)
    assert table.files().count() > 4
    assert table.read().exceptAll(rows).isEmpty() and table.read().count() == 20_000


def test_whole_rows_are_written_once(spark):
    """Rows of an empty table become its base, without a compaction; later ones are laid over it."""
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("n", T.LongType())])
    for kind in ("rows", "sums"):
        table = LakeTable(spark, scratch_folder(spark, "whole"), schema, ["id"], kind=kind).create()

        def add(rows, step, seq):
            if kind == "rows":
                return table.put(rows.withColumn("_op", F.lit("PUT")), step, seq, True)
            return table.append(rows, step, True)

        add(spark.range(100).select("id", F.lit(1).cast("long").alias("n")), "all", 1)
        assert [x["kind"] for x in table.latest().layers] == ["base"]
        add(spark.range(98, 102).select("id", F.lit(2).cast("long").alias("n")), "more", 2)
        assert [x["kind"] for x in table.latest().layers] == ["base", "delta"]
        got = {r.id: r.n for r in table.read().collect()}
        assert got == {i: 1 for i in range(98)} | {i: 2 if kind == "rows" or i > 99 else 3 for i in range(98, 102)}
        found = table.lookup(spark.range(97, 100).select("id"))
        assert sorted(r.n for r in found.collect()) == ([1, 2, 2] if kind == "rows" else [1, 3, 3])
