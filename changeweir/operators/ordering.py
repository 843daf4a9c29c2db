"""Ranks and in-group order that no single task has to hold.

A window without PARTITION BY puts the whole frame into one task, and a window
partitioned by a hot key puts that key's rows into one task. So, whatever the size,

* whole-set ranks are computed over distinct values, cut into value ranges, and
* groups that hold more than one ``parts``-th of the rows are cut along their order column,

with the rows before each range added from a table of range totals.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

#: Ranges that values, and the rows of a large group, are cut into; a group is large above this share of all rows.
PARTS = 64


def _literal(value, data_type) -> Column:
    # Through text: a Python datetime as literal would depend on the driver's zone.
    return F.lit(None if value is None else str(value)).cast(data_type)


# -- ranks over the whole set ---------------------------------------------------


def _counted_before(df: DataFrame, value: str, descending: bool, slices: int) -> DataFrame:
    """Distinct values with ``_before``: how many rows sort strictly ahead of each."""
    freq = df.groupBy(value).agg(F.count(F.lit(1)).alias("_n"))
    # The cut points are a fixed-size driver read; any points give right ranks,
    # since they are literals to everything after, also when a task is retried.
    quantiles = [i / slices for i in range(1, slices)]
    points = sorted(set(freq.select(F.percentile_approx(value, quantiles, 10_000)).head()[0] or []))
    cuts = F.array(*[_literal(p, freq.schema[value].dataType) for p in points]) if points else None

    slice_no = F.size(F.filter(cuts, lambda p: p < F.col(value))) if points else F.lit(0)
    if descending:
        slice_no = F.lit(len(points)) - slice_no
    # NULL sorts last either way.
    freq = freq.withColumn("_slice", F.when(F.col(value).isNull(), len(points) + 1).otherwise(slice_no))

    by_slice = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        freq.groupBy("_slice")
        .agg(F.sum("_n").alias("_rows"))
        .select("_slice", F.coalesce(F.sum("_rows").over(by_slice), F.lit(0)).alias("_offset"))
    )  # at most slices + 1 rows
    order = F.desc_nulls_last(value) if descending else F.asc_nulls_last(value)
    ahead = Window.partitionBy("_slice").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return freq.join(F.broadcast(offsets), "_slice").select(
        F.col(value).alias("_value"),
        (F.col("_offset") + F.coalesce(F.sum("_n").over(ahead), F.lit(0))).alias("_before"),
    )


def rank_over_all(df: DataFrame, value: str, out: str, descending: bool = False, slices: int = PARTS) -> DataFrame:
    """``RANK() OVER (ORDER BY value)``, NULLs last, as BIGINT."""
    ranks = _counted_before(df, value, descending, slices)
    return (
        df.join(ranks, df[value].eqNullSafe(ranks["_value"]))
        .withColumn(out, (F.col("_before") + 1).cast("bigint"))
        .drop("_value", "_before")
    )


def percent_rank_over_all(df: DataFrame, value: str, out: str, slices: int = PARTS) -> DataFrame:
    """``PERCENT_RANK() OVER (ORDER BY value)``, NULLs last."""
    total = df.select(F.count(F.lit(1))).scalar()
    ranked = rank_over_all(df, value, "_rank", slices=slices)
    return ranked.withColumn(
        out, F.when(total > 1, (F.col("_rank") - 1).cast("double") / (total - 1)).otherwise(F.lit(0.0))
    ).drop("_rank")


# -- order within groups ----------------------------------------------------------

#: Types of order columns that quantiles are known for; along others a group is one range.
_QUANTILES = (T.NumericType, T.DateType, T.TimestampType, T.TimestampNTZType)


def _ranges(df: DataFrame, key: list[str], order: Sequence[str], parts: int) -> DataFrame:
    """``_k_<key>, _cuts`` of each group with more than one ``parts``-th of the rows: fewer than ``parts`` rows.

    Groups are counted, and their quantiles estimated, before the shuffle; any cut points give right numbers. They are
    written into the rows by a join, so a task that is run again sees the same ones.
    """
    first = order[0]
    groups = df.groupBy(*[F.col(k).alias(f"_k_{k}") for k in key])
    if isinstance(df.schema[first].dataType, _QUANTILES):
        cuts = F.percentile_approx(first, [i / parts for i in range(1, parts)], 1000)
    else:
        cuts = F.array().cast(T.ArrayType(df.schema[first].dataType))
    counted = groups.agg(F.count(F.lit(1)).alias("_n"), cuts.alias("_cuts"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counted.filter(F.col("_n") * parts > total).select(*[f"_k_{k}" for k in key], F.array_distinct("_cuts").alias("_cuts"))


def _oriented(order: Sequence[str], descending: bool) -> list[Column]:
    return [F.desc_nulls_last(c) if descending else F.asc_nulls_first(c) for c in order]


def number_in_group(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str],
    descending: bool = False,
    number: str | None = None,
    previous: dict[str, str] | None = None,
    parts: int = PARTS,
) -> DataFrame:
    """``ROW_NUMBER`` and ``LAG`` per ``key`` (a column or several) along ``order``, with large groups cut.

    ``order`` must identify a row within its key. ``previous`` maps output columns
    to the columns taken from the row before. Rows with the same first order column share a range.
    """
    previous, key = previous or {}, [key] if isinstance(key, str) else list(key)
    same = lambda a, b, names: reduce(lambda x, y: x & y, [F.col(a + k).eqNullSafe(F.col(b + k)) for k in names])
    # Large groups are few, so their cuts are joined to the rows where these lie.
    cut = df.join(F.broadcast(_ranges(df, key, order, parts)), same("", "_k_", key), "left")
    slice_no = F.coalesce(F.size(F.filter("_cuts", lambda p: p < F.col(order[0]))), F.lit(0))
    cut = cut.withColumn("_slice", F.when(F.col("_cuts").isNull(), 0).otherwise(slice_no)).drop("_cuts", *[f"_k_{k}" for k in key])

    at_slice = Window.partitionBy(*key, "_slice").orderBy(*_oriented(order, descending))
    cols = {out: F.lag(src).over(at_slice) for out, src in previous.items()}
    numbered = cut.withColumns(cols | {"_place": F.row_number().over(at_slice).cast("bigint")})

    # Totals and last row of each range of a large group: at most parts + 1 rows a group, fewer than parts groups.
    position = F.struct(*[F.col(c) for c in order])
    last = F.min_by if descending else F.max_by
    edges = cut.groupBy(*key, "_slice").agg(
        F.count(F.lit(1)).alias("_rows"),
        *[last(F.struct(F.col(src).alias("v")), position).alias(f"_edge_{out}") for out, src in previous.items()],
    )
    along = Window.partitionBy(*key).orderBy(F.desc("_slice") if descending else F.asc("_slice"))
    edges = edges.select(
        *[F.col(c).alias(f"_e_{c}") for c in [*key, "_slice"]],
        F.sum("_rows").over(along.rowsBetween(Window.unboundedPreceding, -1)).alias("_ahead"),
        *[F.lag(f"_edge_{out}").over(along).alias(f"_edge_{out}") for out in previous],
    ).filter(F.col("_ahead") > 0)
    joined = numbered.join(edges, same("", "_e_", [*key, "_slice"]), "left")
    first = (F.col("_place") == 1) & F.col("_ahead").isNotNull()
    fixes = {out: F.when(first, F.col(f"_edge_{out}.v")).otherwise(F.col(out)) for out in previous}
    if number:
        fixes[number] = F.col("_place") + F.coalesce("_ahead", F.lit(0))
    return joined.withColumns(fixes).select(*df.columns, *previous, *([number] if number else []))
