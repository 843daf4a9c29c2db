"""Declared tables: columns, keys, required columns and references."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T

MONEY = T.DecimalType(10, 2)
#: SUM over MONEY; wide enough for 10^16 rows of average size.
MONEY_SUM = T.DecimalType(20, 2)


@dataclass(frozen=True)
class TableSpec:
    """A keyed table.

    ``references`` maps a column to ``(table, column)``. ``defaults`` maps a
    column to a SQL expression used when an insert leaves it out.
    """

    name: str
    schema: T.StructType
    key: tuple[str, ...]
    required: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    references: dict[str, tuple[str, str]] = field(default_factory=dict)
    defaults: dict[str, str] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields.items()])


_LONG, _TEXT, _DATE, _TIME = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType()

CUSTOMERS = TableSpec(
    "customers",
    _struct(id=_LONG, name=_TEXT, email=_TEXT, created_at=_TIME),
    key=("id",),
    required=("id", "name", "email"),
    unique=("id", "email"),
    defaults={"created_at": "now"},
)

ORDERS = TableSpec(
    "orders",
    _struct(id=_LONG, customer_id=_LONG, order_date=_DATE, amount=MONEY, status=_TEXT, created_at=_TIME),
    key=("id",),
    required=("id", "customer_id", "order_date", "amount", "status"),
    unique=("id",),
    references={"customer_id": ("customers", "id")},
    defaults={"order_date": "today", "status": "'pending'", "created_at": "now"},
)

SHOP_CUSTOMERS = TableSpec(
    "customers",
    _struct(customer_id=_LONG, email=_TEXT, name=_TEXT, created_at=_TIME, updated_at=_TIME),
    key=("customer_id",),
    required=("customer_id",),
    unique=("customer_id",),
)

SHOP_PRODUCTS = TableSpec(
    "products",
    _struct(product_id=_LONG, sku=_TEXT, name=_TEXT, price=MONEY, category=_TEXT, created_at=_TIME),
    key=("product_id",),
    required=("product_id",),
    unique=("product_id",),
)

SHOP_ORDERS = TableSpec(
    "orders",
    _struct(
        order_id=_LONG,
        customer_id=_LONG,
        product_id=_LONG,
        quantity=_LONG,
        total_amount=MONEY,
        order_status=_TEXT,
        created_at=_TIME,
        updated_at=_TIME,
    ),
    key=("order_id",),
    required=("order_id", "customer_id", "product_id"),
    unique=("order_id",),
    references={"customer_id": ("customers", "customer_id"), "product_id": ("products", "product_id")},
)

#: The two-table shop of the SQL pipeline.
SALES = {spec.name: spec for spec in (CUSTOMERS, ORDERS)}
#: The three-table shop of the change-stream pipeline, in snapshot order.
SHOP = {spec.name: spec for spec in (SHOP_CUSTOMERS, SHOP_PRODUCTS, SHOP_ORDERS)}

#: One row event as it travels from source to sink.
CHANGE_RECORD = T.StructType(
    [
        T.StructField("table_name", _TEXT),
        T.StructField("mod_type", _TEXT),
        T.StructField("data", _TEXT),
        T.StructField("old_data", _TEXT),
        T.StructField("commit_ts", _TIME),
        T.StructField("seq", _LONG),
        T.StructField("target_table", _TEXT),
    ]
)

#: Rows of a message topic.
TOPIC_ROW = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", _TEXT),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", _LONG),
        T.StructField("timestamp", T.TimestampType()),
    ]
)
