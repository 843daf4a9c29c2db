"""Collapsing a change log to current state by primary key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeweir.schemas import TableSpec

#: What every stored row remembers of the change that wrote it.
META = ["_op", "_commit_ts", "_seq"]


def with_meta(changes: DataFrame, spec: TableSpec) -> DataFrame:
    """Typed changes (``mod_type, commit_ts, seq`` and the row) in stored form."""
    return changes.select(
        *spec.columns,
        F.col("mod_type").alias("_op"),
        F.col("commit_ts").alias("_commit_ts"),
        F.col("seq").alias("_seq"),
    )


def version(prefix: str = "") -> Column:
    return F.struct(F.col(f"{prefix}_commit_ts"), F.col(f"{prefix}_seq"))


def latest_per_key(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The newest stored row of each key, tombstones included.

    ``max_by`` is combined before the shuffle, so a key with a third of all
    changes sends one row per task.
    """
    rest = [c for c in rows.columns if c not in key]
    newest = rows.groupBy(*key).agg(F.max_by(F.struct(*rest), version()).alias("_r"))
    return newest.select(*key, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*rows.columns)


def live(rows: DataFrame) -> DataFrame:
    """What a reader sees: no tombstones, no bookkeeping."""
    return rows.filter(F.col("_op") != "DELETE").drop(*META)


def apply_changes(state: DataFrame | None, changes: DataFrame, spec: TableSpec) -> DataFrame:
    """``state`` (stored form) after ``changes``, whatever their order, duplicates included.

    Tombstones stay in the result: a late update must not bring a deleted row back.
    """
    incoming = with_meta(changes, spec)
    rows = incoming if state is None else state.unionByName(incoming)
    return latest_per_key(rows, spec.key)


def without_repeats(changes: DataFrame, key: Sequence[str]) -> DataFrame:
    """Each change once: the same key, commit time and sequence is the same change."""
    return changes.dropDuplicates([*key, "commit_ts", "seq"])


def deleted_keys(rows: DataFrame, key: Sequence[str]) -> DataFrame:
    return rows.filter(F.col("_op") == "DELETE").select(*key, F.col("_commit_ts").alias("deleted_at"))
