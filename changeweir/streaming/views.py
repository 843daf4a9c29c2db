"""Marts kept current from the changes of each batch.

The work of a refresh follows the batch and the groups it touches:

* counts and sums live in additive tables (a row's old image subtracts, its new
  one adds), keyed finely enough that MIN, MAX and COUNT DISTINCT follow from
  which keys still count: per customer and date, per status and date, per day
  and customer. A group with a third of all orders costs its distinct keys, not
  its orders;
* a maintained copy of the orders laid out by customer answers "this customer's
  orders" from the buckets concerned;
* every view is a table itself; only rows of touched groups are replaced.

A refresh is told the version it reads of each source table and commits under
that version, so a repeated one changes nothing. Marts that are switched on over filled tables, or were off for a
while, first catch up: from the full models at one version of both tables, then merge by merge.
"""

from __future__ import annotations

import re
from functools import reduce
from itertools import zip_longest

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from changeweir.functions.columns import day, mean, money_sum
from changeweir.operators.lake import BEFORE, LakeTable, Probe
from changeweir.plans.models import MODELS, Thresholds, build_models, daily_of, summary_of
from changeweir.schemas import MONEY, MONEY_SUM, ORDERS
from changeweir.streaming.jobs import together

_L, _S, _D, _N, _F = T.LongType(), T.StringType(), T.DateType(), T.TimestampNTZType(), T.DoubleType()


def _schema(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields.items()])


_TOTALS = {"n": _L, "n_amount": _L, "total": MONEY_SUM}
_SUMS = {
    "by_customer": (_schema(customer_id=_L, order_date=_D, **_TOTALS), ["customer_id", "order_date"], ["customer_id"]),
    "by_status": (_schema(status=_S, order_date=_D, **_TOTALS), ["status", "order_date"], ["status"]),
    "by_day": (_schema(metric_date=_N, customer_id=_L, **_TOTALS), ["metric_date", "customer_id"], ["metric_date"]),
}
_VIEWS = {
    "fct_customer_order_summary": (
        _schema(
            customer_id=_L,
            customer_name=_S,
            customer_email=_S,
            order_count=_L,
            total_spent=MONEY_SUM,
            avg_order_amount=_F,
            last_order_date=_D,
        ),
        ["customer_id"],
        ["customer_id"],
    ),
    "dim_customer_spending_tier": (
        _schema(
            customer_id=_L,
            customer_name=_S,
            customer_email=_S,
            total_spent=MONEY_SUM,
            order_count=_L,
            customer_tier=_S,
        ),
        ["customer_id"],
        ["customer_id"],
    ),
    "fct_order_status_dashboard": (
        _schema(status=_S, order_count=_L, total_amount=MONEY_SUM, avg_amount=_F, earliest_order=_D, latest_order=_D),
        ["status"],
        ["status"],
    ),
    "fct_daily_order_metrics": (
        _schema(metric_date=_N, total_orders=_L, daily_revenue=MONEY_SUM, avg_order_value=_F, unique_customers=_L),
        ["metric_date"],
        ["metric_date"],
    ),
    "fct_high_value_orders": (
        _schema(
            order_id=_L,
            customer_id=_L,
            customer_name=_S,
            customer_email=_S,
            amount=MONEY,
            order_date=_D,
            status=_S,
            order_created_at=_N,
        ),
        ["order_id"],
        ["order_id"],
    ),
    "recent_orders": (
        _schema(customer_id=_L, customer_name=_S, order_id=_L, amount=MONEY, status=_S, created_at=_N, rank=_L),
        ["customer_id", "rank"],
        ["customer_id"],
    ),
}


class MaintainedMarts:
    """The marts over a ``customers`` and an ``orders`` lake table."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        customers: LakeTable,
        orders: LakeTable,
        thresholds: Thresholds = Thresholds(),
        keep_recent: int = 10,
        **table_options,
    ):
        self.spark, self.customers, self.orders = spark, customers, orders
        self.thresholds, self.keep_recent = thresholds, keep_recent

        def table(name: str, schema, key, bucket_by, kind: str) -> LakeTable:
            return LakeTable(spark, f"{root}/{name}", schema, key, kind, bucket_by, **table_options).create()

        self.sums = {n: table(n, *spec, kind="sums") for n, spec in _SUMS.items()}
        self.views = {n: table(n, *spec, kind="rows") for n, spec in _VIEWS.items()}
        self.orders_by_customer = table(
            "orders_by_customer", ORDERS.schema, ["customer_id", "id"], ["customer_id"], "rows"
        )
        # Only its commits matter: the newest one's id says up to which versions the marts are.
        self.positions = LakeTable(spark, f"{root}/position", T.StructType([]), kind="log").create()

    def read(self, view: str) -> DataFrame:
        return self.views[view].read()

    def frames(self) -> dict[str, DataFrame]:
        return {name: table.read() for name, table in self.views.items()}

    def started(self) -> bool:
        """Whether a first refresh has been completed: each one commits to every table."""
        tables = [*self.sums.values(), *self.views.values(), self.orders_by_customer]
        return all(t.latest().version > 0 for t in tables)

    # -- where the marts stand -----------------------------------------------------------

    def _noted(self, kind: str) -> tuple[int, int] | None:
        """The versions that the newest note names, if it is of this kind."""
        found = re.fullmatch(rf"{kind}-o(\d+)-c(\d+)", self.positions.latest().batch_id)
        return found and (int(found[1]), int(found[2]))

    def position(self) -> tuple[int, int] | None:
        """Versions of orders and customers that every view stands at; None before the first."""
        return self._noted("at")

    def _note(self, kind: str, orders_version: int, customers_version: int) -> None:
        self.positions.mark(f"{kind}-o{orders_version}-c{customers_version}")

    def catch_up(self) -> None:
        """Bring the marts to the tables' newest versions, from wherever they stand.

        Marts that have never stood anywhere are filled from the tables at one version of each. That version is noted
        first, so a backfill that was cut short goes on at the same one, whatever has been merged since. What was
        merged after the marts' position follows merge by merge, in order.
        """
        newest = self.orders.latest().version, self.customers.latest().version
        if self.position() is None:
            if self._noted("fill") is None and self.started():
                raise RuntimeError("these marts were kept without noting their position; remove them to have them filled anew")
            at = self._noted("fill")
            if at is None:
                at = newest
                self._note("fill", *at)
            self._backfill(*at)
        had = self.position()
        merged = [
            [v for v in range(since + 1, to + 1) if table.at(v).operation == "merge"]
            for table, since, to in zip((self.orders, self.customers), had, newest)
        ]
        for o, c in zip_longest(*merged):
            at = self.position()
            self.refresh(o or at[0], c or at[1])

    def _backfill(self, orders_version: int, customers_version: int) -> None:
        """Every table and view in full, as of these versions. Tables that were filled before a crash are left alone."""
        step, seq = f"snapshot-o{orders_version}-c{customers_version}", orders_version + customers_version
        orders, customers = self.orders.read(orders_version), self.customers.read(customers_version)
        inserted = orders.withColumns({"_op": F.lit("INSERT"), BEFORE: F.lit(None).cast(ORDERS.schema)})
        models = build_models({"customers_cdc": customers, "orders_cdc": orders}, self.thresholds)
        newest = Window.partitionBy("customer_id").orderBy(F.desc("created_at"), F.desc("order_id"))
        recent = models["int_customer_orders"].withColumnRenamed("order_created_at", "created_at")
        # Filtered by its rank, each task keeps only so many rows a customer before they are dealt out.
        recent = recent.withColumn("rank", F.row_number().over(newest).cast("bigint")).filter(F.col("rank") <= self.keep_recent)

        def put(table: LakeTable, rows: DataFrame) -> None:
            typed = [F.col(f.name).cast(f.dataType).alias(f.name) for f in table.schema.fields]
            if not table.committed(step):
                table.put(rows.select(*typed, F.lit("PUT").alias("_op")), step, seq, True)

        def add(name: str, by: list) -> None:
            if not self.sums[name].committed(step):
                self._add(name, inserted, by, step, True)

        frames = {name: recent if name == "recent_orders" else models[name] for name in self.views}
        together(
            self.spark,
            lambda: add("by_customer", ["customer_id", "order_date"]),
            lambda: add("by_status", ["status", "order_date"]),
            lambda: add("by_day", [day("created_at").alias("metric_date"), "customer_id"]),
            lambda: put(self.orders_by_customer, orders),
            *[lambda name=name, rows=rows: put(self.views[name], rows) for name, rows in frames.items()],
        )
        self._note("at", orders_version, customers_version)

    # -- one refresh -----------------------------------------------------------------

    def refresh(self, orders_version: int, customers_version: int) -> None:
        """Bring every view from the changes made by these two source versions up to date.

        A version that the marts' position has passed adds nothing.
        """
        had = self.position() or (0, 0)
        if orders_version <= had[0] and customers_version <= had[1] and self.position():
            return
        o, c = self.orders.changes(orders_version), self.customers.changes(customers_version)
        o, c = o.filter(F.lit(orders_version > had[0])), c.filter(F.lit(customers_version > had[1]))
        orders_version, customers_version = max(orders_version, had[0]), max(customers_version, had[1])
        # What adds up commits under the version of the orders alone, whatever it is refreshed with.
        self.step, self.orders_step = f"o{orders_version}-c{customers_version}", f"orders-{orders_version}"
        self.seq = orders_version + customers_version
        self.customers_version = customers_version
        touched = (
            o.select("customer_id")
            .unionByName(o.select(F.col(f"{BEFORE}.customer_id")))
            .unionByName(c.select(F.col("id").alias("customer_id")))
            .filter(F.col("customer_id").isNotNull())
            .distinct()
        ).persist()
        kept = [touched]

        def touched_customers() -> tuple[Probe, DataFrame]:
            """The touched customers, counted once, and those of them that exist, looked up once."""
            probe = self.customers.probe(touched)
            found = self.customers.lookup(probe, self.customers_version)
            alive = found.filter(F.col("_op") != "DELETE").drop("_op", "_commit_ts", "_seq")
            staged = MODELS["stg_customers"].build({"customers_cdc": alive}, self.thresholds).persist()
            kept.append(staged)
            return probe, staged

        try:
            (probe, staged), *_ = together(
                self.spark,
                touched_customers,
                lambda: self._add("by_customer", o, ["customer_id", "order_date"]),
                lambda: self._add("by_status", o, ["status", "order_date"]),
                lambda: self._add("by_day", o, [day("created_at").alias("metric_date"), "customer_id"]),
                lambda: self._index_orders(o),
            )
            together(
                self.spark,
                lambda: self._refresh_summary(touched, probe, staged),
                lambda: self._refresh_status(o),
                lambda: self._refresh_daily(o),
                lambda: self._refresh_high_value(o, c, staged),
                lambda: self._refresh_recent(o, c, probe, staged),
            )
        finally:
            for frame in kept:
                frame.unpersist()
        self._note("at", orders_version, customers_version)

    # -- additive tables -----------------------------------------------------------------

    def _signed(self, o: DataFrame) -> DataFrame:
        """Old images with sign -1, new ones with +1, from one pass over the changes."""
        cols = ORDERS.columns
        old = ", ".join(f"{BEFORE}.{c} AS {c}" for c in cols)
        new = ", ".join(cols)
        return o.selectExpr(
            f"inline(array(IF({BEFORE} IS NOT NULL, struct(-1L AS sign, {old}), NULL),"
            f" IF(_op <> 'DELETE', struct(1L AS sign, {new}), NULL)))"
        ).filter("sign IS NOT NULL")

    def _add(self, name: str, o: DataFrame, by: list, step: str | None = None, whole: bool = False) -> None:
        sums = (
            self._signed(o)
            .groupBy(*by)
            .agg(
                F.sum("sign").alias("n"),
                F.sum(F.when(F.col("amount").isNotNull(), F.col("sign")).otherwise(0)).alias("n_amount"),
                F.coalesce(F.sum(F.col("sign") * F.col("amount")), F.lit(0)).cast(MONEY_SUM).alias("total"),
            )
        )
        self.sums[name].append(sums, step or self.orders_step, whole)

    def _index_orders(self, o: DataFrame) -> None:
        """Orders by customer. A deleted order, or one that changed hands, leaves its old customer."""
        kept = F.col("_op") != "DELETE"
        moved = ~F.col("customer_id").eqNullSafe(F.col(f"{BEFORE}.customer_id"))
        left = o.filter(F.col(BEFORE).isNotNull() & (~kept | moved)).select(f"{BEFORE}.*")
        rows = (
            o.filter(kept)
            .select(*ORDERS.columns)
            .withColumn("_op", F.lit("PUT"))
            .unionByName(left.withColumn("_op", F.lit("DELETE")))
        )
        self.orders_by_customer.put(rows, self.orders_step, self.seq)

    # -- views -----------------------------------------------------------------------------

    def _replace(self, view: str, touched: DataFrame, rows: DataFrame) -> None:
        """Every touched key gets its new row, or a tombstone where it has none any more."""
        table = self.views[view]
        new = rows.select(
            *[F.col(k).alias(f"_k_{k}") for k in table.key],
            *[c for c in table.columns if c not in table.key],
            F.lit("PUT").alias("_put"),
        )
        same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in table.key])
        op = F.coalesce("_put", F.lit("DELETE")).alias("_op")
        table.put(touched.join(new, same, "left").select(*table.columns, op), self.step, self.seq)

    def _refresh_summary(self, touched: DataFrame, probe: Probe, staged: DataFrame) -> None:
        totals = (
            self.sums["by_customer"]
            .lookup(probe)
            .filter(F.col("n") > 0)
            .groupBy("customer_id")
            .agg(
                F.sum("n").alias("n"),
                F.sum("n_amount").alias("n_amount"),
                money_sum("total").alias("total"),
                F.max("order_date").alias("last_order_date"),
            )
        )
        rows = summary_of(staged, totals).persist()
        try:
            tiers = MODELS["dim_customer_spending_tier"].build({"fct_customer_order_summary": rows}, self.thresholds)
            self._replace("fct_customer_order_summary", touched, rows)
            self._replace("dim_customer_spending_tier", touched, tiers)
        finally:
            rows.unpersist()

    def _refresh_status(self, o: DataFrame) -> None:
        touched = self._signed(o).select("status").distinct()
        rows = (
            self.sums["by_status"]
            .lookup(touched)
            .filter(F.col("n") > 0)
            .groupBy("status")
            .agg(
                F.sum("n").alias("order_count"),
                money_sum("total").alias("total_amount"),
                mean(F.sum("total"), F.sum("n_amount")).alias("avg_amount"),
                F.min("order_date").alias("earliest_order"),
                F.max("order_date").alias("latest_order"),
            )
        )
        self._replace("fct_order_status_dashboard", touched, rows)

    def _refresh_daily(self, o: DataFrame) -> None:
        touched = self._signed(o).select(day("created_at").alias("metric_date")).distinct()
        rows = daily_of(self.sums["by_day"].lookup(touched).filter(F.col("n") > 0))
        self._replace("fct_daily_order_metrics", touched, rows)

    def _refresh_high_value(self, o: DataFrame, c: DataFrame, staged: DataFrame) -> None:
        """Changed orders, and all orders of changed customers, against the threshold."""
        # A tombstone under a customer is an order that moved away: alive elsewhere, and not this customer's to remove.
        of_changed_customers = self.orders_by_customer.lookup(c.select(F.col("id").alias("customer_id"))).filter(
            F.col("_op") != "DELETE"
        )
        candidates = (
            o.filter(F.col("_op") != "DELETE")
            .select(*ORDERS.columns)
            .unionByName(of_changed_customers.select(*ORDERS.columns))
            .dropDuplicates(["id"])
        )
        seen = (
            o.select(F.col("id").alias("order_id"))
            .unionByName(of_changed_customers.select(F.col("id").alias("order_id")))
            .distinct()
        )
        dear = candidates.filter(F.col("amount") >= self.thresholds.high_value)
        frames = {
            "stg_orders": MODELS["stg_orders"].build({"orders_cdc": dear}, self.thresholds),
            "stg_customers": staged,
        }
        rows = MODELS["int_customer_orders"].build(frames, self.thresholds)
        self._replace("fct_high_value_orders", seen, rows)

    def _refresh_recent(self, o: DataFrame, c: DataFrame, probe: Probe, staged: DataFrame) -> None:
        """Newest orders per touched customer.

        New rows compete with the view's own. Only where a kept row left or aged,
        or a customer appeared, are the customer's other orders looked at again.
        """
        view = self.views["recent_orders"].lookup(probe)
        view = view.filter(F.col("_op") != "DELETE").drop("_op", "_commit_ts", "_seq").persist()
        try:
            order = [F.desc("created_at"), F.desc("order_id")]
            changed = o.select(
                F.col("id").alias("order_id"),
                "customer_id",
                "amount",
                "status",
                "created_at",
                "_op",
                F.col(f"{BEFORE}.customer_id").alias("_was_of"),
                F.col(f"{BEFORE}.created_at").alias("_was_at"),
            )
            left = (
                (F.col("_op") == "DELETE")
                | (F.col("_was_of") != F.col("customer_id"))
                | (F.col("created_at") < F.col("_was_at"))
            )
            lost = view.join(changed.filter(left).select("order_id"), "order_id", "left_semi").select("customer_id")
            appeared = c.filter(F.col(BEFORE).isNull()).select(F.col("id").alias("customer_id"))
            refill = self.orders_by_customer.lookup(lost.unionByName(appeared).distinct())

            picked = ["customer_id", "order_id", "amount", "status", "created_at"]
            candidates = (
                view.join(changed.select("order_id"), "order_id", "left_anti")
                .select(*picked)
                .unionByName(changed.filter(F.col("_op") != "DELETE").select(*picked))
                .unionByName(
                    refill.filter(F.col("_op") != "DELETE").withColumnRenamed("id", "order_id").select(*picked)
                )
                .dropDuplicates(["order_id"])
            )
            top = candidates.withColumn(
                "rank", F.row_number().over(Window.partitionBy("customer_id").orderBy(*order)).cast("bigint")
            ).filter(F.col("rank") <= self.keep_recent)
            names = staged.select("customer_id", "customer_name")
            rows = top.join(names, "customer_id").persist()
            places = view.select("customer_id", "rank").unionByName(rows.select("customer_id", "rank")).distinct()
            try:
                self._replace("recent_orders", places, rows)
            finally:
                rows.unpersist()
        finally:
            view.unpersist()
