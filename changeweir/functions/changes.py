"""Columns that decode change messages."""

from __future__ import annotations

from collections.abc import Collection, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from changeweir.schemas import TableSpec

_IMAGES = "before STRING, after STRING, op STRING"
#: Row images are read as text, so the JSON inside them is kept as written.
ENVELOPE = f"{_IMAGES}, payload STRUCT<{_IMAGES}>"

TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
CORRUPT = "_corrupt"


def mod_type(raw: Column, strict: bool = False) -> Column:
    """INSERT, UPDATE or DELETE from whatever a source calls it.

    A missing type is an INSERT. Otherwise the first word found decides, in the
    order insert, update or replace, delete; nothing found gives NULL, or fails
    the query when ``strict``.
    """
    word = F.upper(raw)
    unknown = (
        F.raise_error(F.concat(F.lit("unknown mod type: "), raw)).cast("string") if strict else F.lit(None).cast("string")
    )
    return (
        F.when(raw.isNull() | word.contains("INSERT"), "INSERT")
        .when(word.contains("UPDATE") | word.contains("REPLACE"), "UPDATE")
        .when(word.contains("DELETE"), "DELETE")
        .otherwise(unknown)
    )


def envelope(value: Column) -> Column:
    """Generator of ``before, after, op, payload`` of a message, parsed once per row."""
    opened = F.from_json(value.cast("string"), ENVELOPE)
    return F.inline(F.array(opened)).alias("_before", "_after", "_op", "_payload")


#: Message operation codes: create, snapshot read, update, delete.
OP_CODES = {"c": "INSERT", "r": "INSERT", "u": "UPDATE", "d": "DELETE"}


def mod_type_of_op(op: Column) -> Column:
    out = F.lit(None).cast("string")
    for code, name in OP_CODES.items():
        out = F.when(op == code, name).otherwise(out)
    return out


def parsed(data: Column, spec: TableSpec) -> Column:
    """Generator of the declared columns of a JSON row image as text, each named ``_t_<column>``.

    ``_t__corrupt`` holds the text when it is no JSON object. As a generator's
    output these are plain columns: later filters cannot pull the parsing along.
    """
    fields = ", ".join(f"`{c}` STRING" for c in spec.columns)
    opened = F.from_json(data, f"{fields}, {CORRUPT} STRING", {"columnNameOfCorruptRecord": CORRUPT})
    return F.inline(F.array(opened)).alias(*[f"_t_{c}" for c in [*spec.columns, CORRUPT]])


def typed(spec: TableSpec) -> list[Column]:
    """Each declared column cast from its parsed text; what does not fit its type becomes NULL."""
    return [F.col(f"_t_{f.name}").try_cast(f.dataType).alias(f.name) for f in spec.schema.fields]


def faults(data: Column, spec: TableSpec, columns: Sequence[str], excused: Collection[str] = ()) -> Column:
    """Reasons a parsed row image cannot be stored, looking at ``columns``; empty when it can. ``excused`` ones may be missing."""
    corrupt = F.col(f"_t_{CORRUPT}")
    reasons = [F.when(data.isNull() | corrupt.isNotNull(), F.lit("not json"))]
    for f in spec.schema.fields:
        if f.name not in columns:
            continue
        text = F.col(f"_t_{f.name}")
        if f.name in spec.required and f.name not in excused:
            reasons.append(F.when(data.isNotNull() & corrupt.isNull() & text.isNull(), F.lit(f"missing {f.name}")))
        if f.dataType.simpleString() != "string":
            bad = corrupt.isNull() & text.isNotNull() & text.try_cast(f.dataType).isNull()
            reasons.append(F.when(bad, F.lit(f"bad {f.name}")))
    return F.concat_ws("; ", *reasons)


def row_json(columns: list[str | Column]) -> Column:
    return F.to_json(F.struct(*columns), {"timestampNTZFormat": TIME_FORMAT})


def key_text(spec: TableSpec) -> Column:
    """``column=value`` of a row's key, for logs and audit."""
    parts = [F.concat(F.lit(f"{k}="), F.coalesce(F.col(k).cast("string"), F.lit("unknown"))) for k in spec.key]
    return F.concat_ws(",", *parts)


def changed_columns(before: str, after: str, columns: list[str]) -> Column:
    """Names of the columns that differ between two row images, comma separated."""
    differs = [
        F.when(~F.col(f"{before}.{c}").eqNullSafe(F.col(f"{after}.{c}")), F.lit(c)) for c in columns
    ]
    return F.concat_ws(",", *differs)
