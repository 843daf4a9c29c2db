"""From raw change events to typed rows per table, with rejects kept aside."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeweir.functions import changes as fch
from changeweir.operators.ordering import PARTS, number_in_group
from changeweir.schemas import TableSpec


def snapshot_as_changes(rows: DataFrame, table: str, commit_ts: Column, seq: int = 0) -> DataFrame:
    """Every row of a table as an INSERT; ``seq`` 0 lets any real change win over it."""
    return rows.select(
        F.lit(table).alias("table_name"),
        F.lit("INSERT").alias("mod_type"),
        *rows.columns,
        commit_ts.alias("commit_ts"),
        F.lit(seq).cast("bigint").alias("seq"),
    )


def to_records(changes: DataFrame, spec: TableSpec, namespace: str, old_data: Column | None = None) -> DataFrame:
    """Typed changes as generic change records with a JSON payload."""
    return changes.select(
        F.lit(spec.name).alias("table_name"),
        "mod_type",
        fch.row_json(spec.columns).alias("data"),
        (F.lit(None).cast("string") if old_data is None else old_data).alias("old_data"),
        "commit_ts",
        "seq",
        F.concat_ws(".", F.lit(namespace), F.lit(spec.name)).alias("target_table"),
    )


def snapshot_records(tables: Mapping[str, tuple[DataFrame, TableSpec]], namespace: str, commit_ts: Column) -> DataFrame:
    """Several tables' snapshots as change records, in the order given."""
    parts = [
        to_records(snapshot_as_changes(df, name, commit_ts), spec, namespace) for name, (df, spec) in tables.items()
    ]
    return reduce(DataFrame.unionByName, parts)


def from_envelopes(messages: DataFrame) -> DataFrame:
    """Topic messages with ``op, before, after`` as JSON text; ``after`` is NULL for deletes."""
    rest = [c for c in messages.columns if c not in ("key", "value")]
    opened = messages.select(*rest, fch.envelope(F.col("value")))
    sides = ("op", "before", "after")
    return opened.select(*rest, *[F.coalesce(f"_{c}", f"_payload.{c}").alias(c) for c in sides])


def envelope_records(messages: DataFrame) -> DataFrame:
    """Topic messages as change records; a delete carries its old image as the row.

    The table is the last part of the topic's name. Messages are ordered by time, then partition, then offset (``seq``
    holds the latter two: a partition has fewer than 2^40 messages). A message without an image, and one that is no
    JSON at all, keeps its text as ``data``, so it can be set aside with its reason.
    """
    opened = from_envelopes(messages.withColumn("_text", F.col("value").cast("string")))
    return opened.select(
        F.element_at(F.split("topic", r"\."), -1).alias("table_name"),
        # An op that is not known is set aside later; only a missing type means insert.
        F.coalesce(fch.mod_type_of_op(F.col("op")), F.lit("unknown op")).alias("mod_type"),
        F.coalesce("after", "before", "_text").alias("data"),
        F.col("before").alias("old_data"),
        F.col("timestamp").cast("timestamp_ntz").alias("commit_ts"),
        (F.shiftleft(F.col("partition").cast("bigint"), 40) + F.col("offset")).alias("seq"),
    )


def route(records: DataFrame, namespace: str) -> DataFrame:
    return records.withColumn("target_table", F.concat_ws(".", F.lit(namespace), F.col("table_name")))


def unknown_tables(records: DataFrame, specs: Iterable[str]) -> DataFrame:
    """Records of tables nobody declared. The declared names are a literal list of a few."""
    known = F.col("table_name").isin(*specs)
    return records.filter(~F.coalesce(known, F.lit(False)))


def default_times(rows: DataFrame, columns: tuple[str, ...] = ("created_at", "updated_at")) -> DataFrame:
    """Fill missing row times from the change's commit time, so a replay gives the same row."""
    return rows.withColumns({c: F.coalesce(c, "commit_ts") for c in columns if c in rows.columns})


def insert_defaults(rows: DataFrame, spec: TableSpec, now: Column) -> DataFrame:
    """Declared defaults for columns an insert left out; ``now`` is the same for a row however often it is read."""
    return rows.withColumns({c: F.coalesce(F.col(c), default_of(spec, c, now)) for c in spec.defaults})


def default_of(spec: TableSpec, column: str, now: Column) -> Column:
    values = {"now": now.cast("timestamp_ntz"), "today": now.cast("date")}
    declared = spec.defaults[column]
    return values[declared] if declared in values else F.expr(declared)


def decode_table(records: DataFrame, spec: TableSpec) -> DataFrame:
    """Records of one table as typed rows with ``mod_type, commit_ts, seq, data`` and ``reason``.

    ``reason`` is empty for good rows. Columns not declared are dropped, missing
    ones are NULL, but for an insert's: those get their declared defaults, times as of the commit. A delete
    needs its key only. ``mod_type`` comes in any source's spelling and leaves as INSERT, UPDATE or DELETE; a missing
    one is an INSERT.
    """
    records = records.withColumn("mod_type", fch.mod_type(F.col("mod_type")))
    opened = records.select("mod_type", "commit_ts", "seq", "data", fch.parsed(F.col("data"), spec))
    whole = fch.faults(F.col("data"), spec, spec.columns)
    key_only = fch.faults(F.col("data"), spec, spec.key)
    of_insert = fch.faults(F.col("data"), spec, spec.columns, spec.defaults)
    kind = F.col("mod_type")
    known_type = F.when(kind.isNull(), F.lit("unknown mod type"))
    reason = F.when(kind == "DELETE", key_only).when(kind == "INSERT", of_insert).otherwise(whole)
    rows = opened.select(
        "mod_type",
        "commit_ts",
        "seq",
        *fch.typed(spec),
        "data",
        F.concat_ws("; ", known_type, F.when(reason != "", reason)).alias("reason"),
    )
    now = F.col("commit_ts")
    filled = {c: F.when(kind == "INSERT", F.coalesce(c, default_of(spec, c, now))).otherwise(F.col(c)) for c in spec.defaults}
    return default_times(rows.withColumns(filled))


def decode_all(records: DataFrame, specs: Mapping[str, TableSpec]) -> dict[str, DataFrame]:
    return {name: decode_table(records.filter(F.col("table_name") == name), spec) for name, spec in specs.items()}


def accepted(decoded: DataFrame, spec: TableSpec) -> DataFrame:
    return decoded.filter(F.col("reason") == "").select("mod_type", "commit_ts", "seq", *spec.columns)


def rejected(records: DataFrame, decoded: Mapping[str, DataFrame]) -> DataFrame:
    """Every record that is not stored, with the reason it was set aside."""
    parts = [
        unknown_tables(records, decoded).select(
            "table_name", F.lit("unknown table").alias("reason"), "data", "commit_ts", "seq"
        )
    ]
    for name, rows in decoded.items():
        bad = rows.filter(F.col("reason") != "")
        parts.append(bad.select(F.lit(name).alias("table_name"), "reason", "data", "commit_ts", "seq"))
    return reduce(DataFrame.unionByName, parts)


def row_images(changes: DataFrame, spec: TableSpec, parts: int = PARTS) -> DataFrame:
    """Each change with its row before and after it, in commit order per key.

    The row after a delete is NULL, and so is the row before whatever follows one.
    """
    after = F.when(F.col("mod_type") != "DELETE", F.struct(*spec.columns))
    rows = changes.select(*spec.key, "mod_type", "commit_ts", "seq", after.alias("after"))
    return number_in_group(rows, spec.key, ["commit_ts", "seq"], previous={"before": "after"}, parts=parts)


def audit_diff(images: DataFrame, spec: TableSpec) -> DataFrame:
    """Columns each UPDATE changed, comma separated."""
    columns = [c for c in spec.columns if c not in spec.key]
    return images.filter(F.col("mod_type") == "UPDATE").select(
        *spec.key, "commit_ts", "seq", fch.changed_columns("before", "after", columns).alias("changed")
    )
