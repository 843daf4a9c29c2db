import pytest
from pyspark.sql import functions as F

from changeweir.functions import changes as fch
from changeweir.operators import decode
from changeweir.schemas import ORDERS, SALES, SHOP_ORDERS
from changeweir.sources.feeds import topic_rows


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        (None, "INSERT"),
        ("insert", "INSERT"),
        ("REPLACE_ROW", "UPDATE"),
        ("row_delete", "DELETE"),
        ("zzz", None),
        ("insert_then_delete", "INSERT"),
        ("", None),
    ],
)
def test_mod_type(spark, raw, want):
    df = spark.createDataFrame([(raw,)], "raw STRING")
    assert df.select(fch.mod_type(F.col("raw"))).head()[0] == want


def test_mod_type_strict_fails(spark):
    df = spark.createDataFrame([("zzz",)], "raw STRING")
    with pytest.raises(Exception, match="unknown mod type: zzz"):
        df.select(fch.mod_type(F.col("raw"), strict=True)).collect()


def test_envelopes(spark, rows):
    messages = spark.createDataFrame(
        [
            ('{"before":null,"after":{"id":1,"qty":2},"op":"c"}',),
            ('{"payload":{"before":{"id":1},"after":null,"op":"d"}}',),
            ("no json at all",),
            (None,),
        ],
        "value STRING",
    )
    got = rows(decode.from_envelopes(messages), "op", "before", "after")
    assert got == sorted(
        [("c", None, '{"id":1,"qty":2}'), ("d", '{"id":1}', None), (None, None, None), (None, None, None)], key=repr
    )


def test_envelope_records(spark):
    topic = spark.createDataFrame(
        [("mysql-cdc.appdb.sales", 5, '{"before":{"id":1},"after":null,"op":"d"}')],
        "topic STRING, offset BIGINT, value STRING",
    )
    r = decode.envelope_records(topic_rows(topic)).head()
    assert (r.table_name, r.mod_type, r.data, r.seq) == ("sales", "DELETE", '{"id":1}', 5)


def _records(spark, *rows):
    return spark.createDataFrame(
        [(t, m, d, None, i) for i, (t, m, d) in enumerate(rows)],
        "table_name STRING, mod_type STRING, data STRING, old_data STRING, seq BIGINT",
    ).withColumn("commit_ts", F.expr("TIMESTAMP_NTZ'2025-01-01 00:00:00'"))


def test_every_record_is_stored_or_set_aside(spark):
    good = '{"id":1,"customer_id":"2","order_date":"2025-01-15","amount":"10.50","status":"pending","extra":1}'
    records = _records(
        spark,
        ("orders", "INSERT", good),
        ("orders", "INSERT", '{"customer_id":2}'),
        ("orders", "INSERT", '{"id":1,'),
        ("orders", "INSERT", None),
        ("orders", "INSERT", good.replace("10.50", "ten")),
        ("orders", None, good),
        ("orders", "DELETE", '{"id":9}'),
        ("orders", "DELETE", '{"customer_id":9}'),
        ("invoices", "INSERT", good),
        (None, "INSERT", good),
        ("orders", "row_delete", '{"id":8}'),
        ("orders", "delete", '{"id":7}'),
        ("orders", "unknown op", good),
    )
    decoded = decode.decode_all(records, SALES)
    stored = {r.seq: r for r in decode.accepted(decoded["orders"], ORDERS).collect()}
    aside = {r.seq: r.reason for r in decode.rejected(records, decoded).collect()}
    assert set(stored) == {0, 5, 6, 10, 11}
    assert [stored[i].mod_type for i in (5, 10, 11)] == ["INSERT", "DELETE", "DELETE"]
    assert (stored[0].customer_id, str(stored[0].amount)) == (2, "10.50")
    assert stored[0].created_at == stored[0].commit_ts  # defaulted from the commit, not the clock
    assert aside == {
        1: "missing id; missing amount",
        2: "not json",
        3: "not json",
        4: "bad amount",
        7: "missing id",
        8: "unknown table",
        9: "unknown table",
        12: "unknown mod type",
    }


def test_key_text(spark):
    df = spark.createDataFrame([(7,), (None,)], "order_id BIGINT")
    assert [r[0] for r in df.select(fch.key_text(SHOP_ORDERS)).collect()] == ["order_id=7", "order_id=unknown"]


def test_images_across_delete_and_reinsert(spark):
    changes = spark.sql(
        """SELECT * FROM VALUES ('INSERT', 1, 1, 10.0), ('UPDATE', 2, 1, 20.0), ('DELETE', 3, 1, 20.0),
           ('INSERT', 4, 1, 30.0), ('INSERT', 1, 2, 5.0) AS t(mod_type, seq, id, amount)"""
    ).selectExpr(
        "mod_type",
        "CAST(seq AS BIGINT) AS seq",
        "CAST(id AS BIGINT) AS id",
        "CAST(1 AS BIGINT) AS customer_id",
        "DATE'2025-01-01' AS order_date",
        "CAST(amount AS DECIMAL(10,2)) AS amount",
        "'pending' AS status",
        "TIMESTAMP_NTZ'2025-01-01 00:00:00' AS created_at",
        "TIMESTAMP_NTZ'2025-01-01 00:00:00' AS commit_ts",
    )
    for parts in (1, 50):
        images = decode.row_images(changes, ORDERS, parts=parts).selectExpr(
            "id", "seq", "int(before.amount) AS b", "int(after.amount) AS a"
        )
        got = sorted(tuple(r) for r in images.collect())
        assert got == [(1, 1, None, 10), (1, 2, 10, 20), (1, 3, 20, None), (1, 4, None, 30), (2, 1, None, 5)]
