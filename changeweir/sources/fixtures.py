"""The driver's tables seen as the shop's tables and change logs (FIXTURES.md, part 2)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeweir.session import prepare

_EPOCH = "TIMESTAMP_NTZ'1995-01-01 00:00:00'"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, and for each third one another who never orders."""
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "lower(replace(c_name, '#', '.')) || '@' || lower(c_mktsegment) || '.example.com' AS email",
        f"{_EPOCH} AS created_at",
    )
    return rows.selectExpr(
        "inline(array(struct(id, name, email, created_at), IF(id % 3 = 0, struct(id + 10000000 AS id,"
        " name || '.idle' AS name, 'idle.' || email AS email, created_at), NULL)))"
    ).filter("id IS NOT NULL")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "orders")
        .selectExpr(
            "o_orderkey AS id",
            "o_custkey AS customer_id",
            "CAST(o_orderdate AS DATE) AS order_date",
            "CAST(o_totalprice AS DECIMAL(10,2)) AS amount",
            "CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'O' THEN 'pending' ELSE 'shipped' END AS status",
            "o_orderdate AS created_at",
        )
    )


def shop_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customers(spark, sf_dir).selectExpr(
        "id AS customer_id", "email", "name", "created_at", "created_at AS updated_at"
    )


def shop_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id",
        "'PROD-' || CAST(p_partkey AS STRING) AS sku",
        "p_name AS name",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS price",
        "p_type AS category",
        f"{_EPOCH} AS created_at",
    )


def shop_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id",
        "o_custkey AS customer_id",
        "o_orderkey % 200 AS product_id",
        "o_orderkey % 5 + 1 AS quantity",
        "CAST(o_totalprice AS DECIMAL(10,2)) AS total_amount",
        "o_orderstatus AS order_status",
        "o_orderdate AS created_at",
        "o_orderdate AS updated_at",
    )


def _history(rows: DataFrame, update_when: str, delete_when: str, updated: dict[str, str]) -> DataFrame:
    """Insert, then maybe update, then maybe delete each row: three events from one scan."""

    def event(mod_type: str, seq: int, changes: dict[str, str], delay: str | None) -> str:
        cols = ", ".join(f"{changes.get(c, c)} AS {c}" for c in rows.columns)
        commit = "created_at" if delay is None else f"created_at + INTERVAL {delay}"
        return f"struct('{mod_type}' AS mod_type, CAST({seq} AS BIGINT) AS seq, {cols}, {commit} AS commit_ts)"

    return (
        rows.selectExpr(
            "inline(array("
            + event("INSERT", 1, {}, None)
            + f", IF({update_when}, {event('UPDATE', 2, updated, '1 DAY')}, NULL)"
            + f", IF({delete_when}, {event('DELETE', 3, {}, '2 DAY')}, NULL)"
            + "))"
        )
    ).filter("mod_type IS NOT NULL")


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(
        orders(spark, sf_dir),
        update_when="id % 3 = 0",
        delete_when="id % 5 = 0",
        updated={
            "amount": "CAST(amount * 1.1 AS DECIMAL(10,2))",
            "status": "'delivered'",
            "customer_id": "IF(id % 9 = 0, GREATEST(customer_id - 1, 1), customer_id)",  # some move
        },
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _history(
        customers(spark, sf_dir),
        update_when="id % 4 = 0",
        delete_when="id % 21 = 0",
        updated={"email": "'updated.' || email"},
    )


def faulty_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders with planted duplicates, orphans and missing statuses, from one scan."""
    return (
        orders(spark, sf_dir)
        .selectExpr(
            "inline(array("
            "struct(id, customer_id, order_date, amount, status, created_at),"
            "IF(id % 100 = 0, struct(id, customer_id, order_date, amount, status, created_at), NULL),"
            "IF(id % 101 = 0, struct(id + 10000000 AS id, CAST(-1 AS BIGINT) AS customer_id, order_date,"
            " amount, status, created_at), NULL),"
            "IF(id % 97 = 0, struct(id + 20000000 AS id, customer_id, order_date, amount,"
            " CAST(NULL AS STRING) AS status, created_at), NULL)))"
        )
        .filter("id IS NOT NULL")
    )


def envelopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic messages: a create per order, a delete for every fifth."""
    created = (
        """'{"before":null,"after":{"id":' || CAST(id AS STRING) || ',"qty":' || CAST(id % 5 + 1 AS STRING)"""
        """ || ',"price":"' || CAST(amount AS STRING) || '"},"op":"c"}'"""
    )
    deleted = """'{"before":{"id":' || CAST(id AS STRING) || '},"after":null,"op":"d"}'"""
    return (
        orders(spark, sf_dir)
        .selectExpr(
            f"inline(array(struct(id AS offset, {created} AS value),"
            f" IF(id % 5 = 0, struct(id + 1000000 AS offset, {deleted} AS value), NULL)))"
        )
        .filter("value IS NOT NULL")
        .select(F.lit("mysql-cdc.appdb.sales").alias("topic"), "offset", "value")
    )


def order_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order log as a topic's rows: inserts, updates and deletes in partitions of their own, every sixth update again at the
    same moment in a later partition, and between them cut, unknown and empty messages."""
    image = (
        """'{"id":' || CAST(id AS STRING) || ',"customer_id":' || CAST(customer_id AS STRING) || ',"order_date":"'"""
        """ || CAST(order_date AS STRING) || '","amount":"' || CAST(amount AS STRING) || '","status":"' || STATUS || '","created_at":"'"""
        """ || date_format(created_at, 'yyyy-MM-dd HH:mm:ss') || '"}'"""
    )
    row, returned = image.replace("STATUS", "status"), image.replace("STATUS", "'returned'")

    def message(partition: str, offset: str, value: str, when: str) -> str:
        return f"IF({when}, struct(CAST({partition} AS INT) AS partition, {offset} AS offset, {value} AS value, commit_ts), NULL)"

    wrap = lambda before, after, op: f"'{{\"before\":' || {before} || ',\"after\":' || {after} || ',\"op\":\"{op}\"}}'"
    messages = [
        message("0", "id", wrap("'null'", row, "c"), "mod_type = 'INSERT'"),
        message("1", "id", wrap(row, row, "u"), "mod_type = 'UPDATE'"),
        message("2", "id", wrap(row, "'null'", "d"), "mod_type = 'DELETE'"),
        message("2", "id + 5000000", wrap(row, returned, "u"), "mod_type = 'UPDATE' AND id % 6 = 0"),
        message("0", "id + 10000000", "'{\"op\":\"c\",\"after\":'", "mod_type = 'INSERT' AND id % 17 = 0"),
        message("0", "id + 20000000", wrap("'null'", row, "x"), "mod_type = 'INSERT' AND id % 19 = 0"),
        message("0", "id + 30000000", "CAST(NULL AS STRING)", "mod_type = 'INSERT' AND id % 23 = 0"),
    ]
    rows = order_changes(spark, sf_dir).selectExpr(f"inline(array({', '.join(messages)}))").filter("partition IS NOT NULL")
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.lit("shop.public.orders").alias("topic"),
        "partition",
        F.col("offset").cast("bigint").alias("offset"),
        F.col("commit_ts").cast("timestamp").alias("timestamp"),
    )


def raw_order_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shop-order row images as text, the way an untyped source hands them over.

    Every value is text; some rows lack their key, some are cut short, some carry
    an unknown column, a non-numeric amount or no ``created_at``.
    """
    cut_short = """'{"order_id":"' || CAST(order_id AS STRING)"""
    whole = (
        """'{' || CASE WHEN order_id % 11 = 0 THEN '' ELSE '"order_id":"' || CAST(order_id AS STRING) || '",' END"""
        """ || '"customer_id":"' || CAST(customer_id AS STRING) || '","product_id":' || CAST(product_id AS STRING)"""
        """ || ',"quantity":"' || CAST(quantity AS STRING) || '","total_amount":"'"""
        """ || CASE WHEN order_id % 17 = 0 THEN 'n/a' ELSE CAST(total_amount AS STRING) END || '"'"""
        """ || CASE WHEN order_id % 7 = 0 THEN ',"coupon":"X1"' ELSE '' END || ',"order_status":"'"""
        """ || order_status || '"' || CASE WHEN order_id % 3 = 0 THEN '' ELSE"""
        """ ',"created_at":"' || date_format(created_at, 'yyyy-MM-dd HH:mm:ss') || '"' END || '}'"""
    )
    return shop_orders(spark, sf_dir).selectExpr(
        "order_id AS line_no",
        "'orders' AS table_name",
        f"CASE WHEN order_id % 13 = 0 THEN {cut_short} ELSE {whole} END AS data",
        "created_at + INTERVAL 1 HOUR AS commit_ts",
        "order_id AS seq",
    )
