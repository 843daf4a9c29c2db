"""Data-quality rules kept current from the changes of each batch.

Every rule is a signed count: a row's old image subtracts, its new one adds. Unique rules count rows per value, null
and expression rules the rows that break them, references the children per value and the parents per value. Counts of
touched values are looked up again after each batch, and failing values are replaced by what they are then; so the work
follows the batch, and a value with a third of all rows is one count.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from changeweir.operators.lake import BEFORE, LakeTable
from changeweir.operators.quality import Rule

_TEXT, _LONG = T.StringType(), T.LongType()
_COUNTS = T.StructType([T.StructField("rule", _TEXT), T.StructField("value", _TEXT), T.StructField("n", _LONG), T.StructField("parents", _LONG)])
_FAILING = T.StructType([T.StructField("rule", _TEXT), T.StructField("value", _TEXT), T.StructField("n", _LONG)])
#: Names that rules use for a table's rows and for its staged form, and the columns that staging renames.
_STAGED = {"stg_customers": ("customers", {"customer_id": "id"}), "stg_orders": ("orders", {"order_id": "id"})}


class KeptRules:
    """The rules on ``<table>_cdc`` sources among ``rules``, kept under ``root`` for the given tables."""

    def __init__(self, spark: SparkSession, root: str, tables: Mapping[str, LakeTable], rules: Sequence[Rule], **options):
        self.spark, self.tables = spark, dict(tables)
        self.rules = [r for r in rules if r.table.removesuffix("_cdc") in tables and r.table.endswith("_cdc")]
        key = ["rule", "value"]
        self.counts = LakeTable(spark, f"{root}/counts", _COUNTS, key, "sums", **options).create()
        self.failures = LakeTable(spark, f"{root}/failing", _FAILING, key, "rows", **options).create()
        # Only their commits matter: the newest one's id is the version of the table that was applied last.
        self.positions = {n: LakeTable(spark, f"{root}/position-{n}", T.StructType([]), kind="log").create() for n in tables}

    # -- following the tables --------------------------------------------------------

    def catch_up(self) -> None:
        """Apply every merge that was not applied yet, table by table, each once."""
        for name, table in self.tables.items():
            for version in range(self._position(name) + 1, table.latest().version + 1):
                if table.at(version).operation == "merge":
                    self._apply(name, table, version)

    def _position(self, name: str) -> int:
        """The newest version of a table that was applied."""
        noted = self.positions[name].latest().batch_id
        return int(noted.removeprefix("at-")) if noted.startswith("at-") else 0

    def _apply(self, name: str, table: LakeTable, version: int) -> None:
        step = f"{name}-{version}"  # a step that was cut short is repeated next, and adds nothing twice
        # Counted once for the sums and for the lookup; both come one row a value.
        signed = self._signed(name, table, table.changes(version)).persist()
        try:
            self.counts.append(signed, step)
            touched = signed.select("rule", "value")
            now = self.counts.lookup(touched).select(F.col("rule").alias("_r"), F.col("value").alias("_v"), "n", "parents")
            same = F.col("rule").eqNullSafe(F.col("_r")) & F.col("value").eqNullSafe(F.col("_v"))
            op = F.when(self._fails(), F.lit("PUT")).otherwise(F.lit("DELETE"))
            rows = touched.join(now, same, "left").select("rule", "value", "n", op.alias("_op"))
            self.failures.put(rows, step, self.failures.latest().version + 1)
            self.positions[name].mark(f"at-{version}")
        finally:
            signed.unpersist()

    # -- counting --------------------------------------------------------------------

    def _signed(self, name: str, table: LakeTable, changes: DataFrame) -> DataFrame:
        """``rule, value, n, parents``: what a merge adds to the counts, from one pass over its rows."""
        columns = table.columns
        image = lambda prefix: F.struct(*[F.col(f"{prefix}{c}").alias(c) for c in columns])
        old = F.when(F.col(BEFORE).isNotNull(), F.struct(F.lit(-1).cast("bigint").alias("sign"), image(f"{BEFORE}.").alias("row")))
        new = F.when(F.col("_op") != "DELETE", F.struct(F.lit(1).cast("bigint").alias("sign"), image("").alias("row")))
        rows = changes.select(F.explode(F.array(old, new)).alias("x")).filter("x IS NOT NULL").select("x.sign", "x.row.*")
        terms = [t for r in self.rules for t in self._terms(r, name)]
        if not terms:
            return self.spark.createDataFrame([], _COUNTS)
        facts = rows.select(F.explode(F.array(*terms)).alias("t")).filter("t.counts").select("t.*")
        return facts.groupBy("rule", "value").agg(F.sum("n").alias("n"), F.sum("parents").alias("parents"))

    def _terms(self, rule: Rule, name: str) -> list[Column]:
        """What a row of the table ``name`` adds for a rule: (rule, value, n, parents), where ``counts``."""

        def term(counts: Column, value: Column, n: Column, parents: Column) -> Column:
            zero = F.lit(0).cast("bigint")
            return F.struct(
                F.lit(rule.name).alias("rule"), value.cast("string").alias("value"), F.coalesce(n, zero).alias("n"),
                F.coalesce(parents, zero).alias("parents"), F.coalesce(counts, F.lit(False)).alias("counts"),
            )

        sign, none, out = F.col("sign"), F.lit(0).cast("bigint"), []
        if rule.table == f"{name}_cdc":
            if rule.kind in ("unique", "relationships"):
                out.append(term(F.col(rule.column).isNotNull(), F.col(rule.column), sign, none))
            else:
                broken = F.col(rule.column).isNull() if rule.kind == "not_null" else ~F.coalesce(F.expr(rule.arg), F.lit(False))
                out.append(term(broken, F.lit(""), sign, none))
        if rule.kind == "relationships":
            parent, renamed = _STAGED.get(rule.arg[0], (rule.arg[0].removesuffix("_cdc"), {}))
            if parent == name:
                column = F.col(renamed.get(rule.arg[1], rule.arg[1]))
                out.append(term(column.isNotNull(), column, none, sign))
        return out

    def _fails(self) -> Column:
        named = lambda kind: F.col("rule").isin(*[r.name for r in self.rules if r.kind == kind])
        return (
            F.when(named("unique"), F.col("n") > 1)
            .when(named("relationships"), (F.col("n") > 0) & (F.col("parents") == 0))
            .otherwise(F.col("n") > 0)
        )

    # -- reading ---------------------------------------------------------------------

    def failing(self) -> DataFrame:
        """``rule, value, n``: values that break a rule, and the rows that have them; '' for rules on rows."""
        return self.failures.read()

    def summary(self) -> DataFrame:
        """``rule, n_failed`` of every rule: values for unique rules, rows for the others."""
        of_values = F.col("rule").isin(*[r.name for r in self.rules if r.kind == "unique"])
        found = self.failures.read().groupBy("rule").agg(F.sum(F.when(of_values, 1).otherwise(F.col("n"))).alias("n_failed"))
        names = reduce(DataFrame.unionByName, [self.spark.range(1).select(F.lit(r.name).alias("rule")) for r in self.rules])
        return names.join(F.broadcast(found), "rule", "left").select("rule", F.coalesce("n_failed", F.lit(0)).cast("bigint").alias("n_failed"))
