"""Personal data by regular expressions, checksums and nearby words, in built-in column functions only.

A kind proposes spans by a pattern, a validator (number ranges, Luhn, mod-97) confirms them, and words near the
span adjust a score; kinds that are ambiguous on their own keep only spans whose score reaches 1/2.
Patterns are written so that each runs in linear time on any text: possessive loops, and no second start
within a run of characters whose first start has failed.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: How many code points on each side of a span are searched for context words.
CONTEXT = 40


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), use), F.lit(0))


def digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def luhn(text: Column) -> Column:
    """Whether the digits of ``text`` pass the Luhn check."""
    each = F.transform(F.split(F.reverse(digits(text)), ""), lambda c: F.coalesce(c.try_cast("int"), F.lit(0)))
    doubled = F.transform(each, lambda d, i: F.when(i % 2 == 0, d).when(d > 4, d * 2 - 9).otherwise(d * 2))
    return F.aggregate(doubled, F.lit(0), lambda a, d: a + d) % 10 == 0


def mod97(text: Column) -> Column:
    """Whether an account number (letters as 10..35, first four characters moved to the end) leaves 1 modulo 97."""
    bare = F.upper(F.regexp_replace(text, r"[\x20-]", ""))
    turned = F.concat(F.substr(bare, F.lit(5)), F.substr(bare, F.lit(1), F.lit(4)))
    code = lambda c: F.ascii(c)
    step = lambda a, c: F.when(code(c) >= 65, (a * 100 + code(c) - 55) % 97).otherwise((a * 10 + code(c) - 48) % 97)
    chars = F.filter(F.split(turned, ""), lambda c: c != "")
    return F.aggregate(chars, F.lit(0), step) == 1


def n_digits(text: Column) -> Column:
    return F.length(digits(text))


OCTET = "0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])"

CARD_GROUP = r"(?:[0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}[\x20-][0-9]{4}|[0-9]{16,19}+)"


@dataclass(frozen=True)
class Kind:
    """``needs`` is a cheap test on the text; ``base`` is the score before context words."""

    name: str
    pattern: str
    valid: Callable[[Column], Column]
    needs: Callable[[Column], Column]
    base: float = 1.0
    words: str = ""
    always: bool = True  # the span stays, whatever its score


KINDS = (
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        lambda m: F.lit(True),
        lambda t: F.contains(t, F.lit("@")),
        0.9,
        r"mail|contact|courriel|correo|kontakt",
    ),
    Kind(
        "ip",
        r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
        lambda m: F.rlike(m, F.lit(rf"\A{OCTET}(?:\.{OCTET}){{3}}\z")),
        lambda t: F.rlike(t, F.lit(r"[0-9]\.[0-9]++\.[0-9]")),
        0.7,
        r"\bip\b|address|adresse|server|host",
    ),
    Kind(
        "card",
        r"[0-9](?:[\x20-]?[0-9])++",
        lambda m: n_digits(m).between(16, 19) & luhn(m),
        lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){15}")),
        0.8,
        r"card|visa|carte|karte|tarjeta",
    ),
    Kind(
        "phone",
        r"\+[0-9][\x20().0-9-]+[0-9]",
        lambda m: n_digits(m).between(8, 15),
        lambda t: F.contains(t, F.lit("+")),
        0.7,
        r"phone|call|tel\b|tel\.|fax|mobile|telefon|tél",
    ),
    # Further kinds: cards that stand side by side are one run of digits to the base pattern, which drops it; here each group of
    # 16 digits (in fours) or unbroken one of 16 to 19 inside a longer run is judged by itself. An account number is confirmed by its checksum; a bare national number or a secret needs its words.
    Kind(
        "card_group",
        rf"(?<=[0-9][\x20-]){CARD_GROUP}(?![0-9])|(?<![0-9]){CARD_GROUP}(?=[\x20-][0-9])",
        luhn,
        lambda t: F.rlike(t, F.lit(r"[0-9](?:[\x20-]?[0-9]){16}")),
        0.8,
        r"card|visa|carte|karte|tarjeta",
    ),
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]{4}){2,7}+(?:\x20?[A-Z0-9]{1,3})?+(?![A-Za-z0-9])",
        mod97,
        lambda t: F.rlike(t, F.lit(r"[A-Z]{2}[0-9]{2}\x20?[A-Z0-9]{4}")),
        0.9,
        r"iban|account|konto|compte|cuenta",
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        lambda m: F.lit(True),
        lambda t: F.rlike(t, F.lit(r"[0-9]{3}-[0-9]{2}-[0-9]{4}")),
        0.3,
        r"ssn|social security",
        False,
    ),
    Kind(
        "secret",
        r"(?<![A-Za-z0-9])[A-Fa-f0-9]{32,64}+(?![A-Za-z0-9])",
        lambda m: F.rlike(m, F.lit("[A-Fa-f]")) & F.rlike(m, F.lit("[0-9]")),
        lambda t: F.rlike(t, F.lit("[A-Fa-f0-9]{32}")),
        0.3,
        r"token|secret|password|api.?key|passwd",
        False,
    ),
)
BASE_KINDS = ("email", "ip", "card", "phone")


def _proposals(text: Column, kind: Kind) -> Column:
    """``array<struct<kind,start,end,score>>`` of one kind. Code points, end exclusive.

    Matches and the pieces between them come from the same scan, so a match starts where the lengths before it end.
    """

    def placed(matches: Column) -> Column:
        def at(gaps: Column) -> Column:
            each = F.transform(matches, lambda m, i: F.struct(m.alias("m"), F.length(F.get(gaps, i)).alias("gap")))
            empty = F.array().cast("array<struct<m:string,start:int,end:int>>")
            start = lambda acc, x: acc["end"] + x["gap"]
            stop = lambda acc, x: start(acc, x) + F.length(x["m"])
            step = lambda acc, x: F.struct(
                stop(acc, x).alias("end"),
                # Only what is valid is appended: a text of many plain numbers costs one pass.
                F.when(
                    kind.valid(x["m"]),
                    F.concat(
                        acc["out"],
                        F.array(F.struct(x["m"].alias("m"), start(acc, x).alias("start"), stop(acc, x).alias("end"))),
                    ),
                )
                .otherwise(acc["out"])
                .alias("out"),
            )
            return F.aggregate(each, F.struct(F.lit(0).alias("end"), empty.alias("out")), step, lambda a: a["out"])

        return let(F.split(text, kind.pattern, -1), at)

    def scored(valid: Column) -> Column:
        near = lambda s: F.rlike(
            F.lower(F.substr(text, F.greatest(s["start"] + 1 - CONTEXT, F.lit(1)), s["end"] - s["start"] + 2 * CONTEXT)),
            F.lit(kind.words),
        )
        score = lambda s: F.least(F.lit(1.0), F.when(near(s), F.lit(kind.base + 0.3)).otherwise(F.lit(kind.base)))
        out = F.transform(
            valid,
            lambda s: F.struct(
                F.lit(kind.name).alias("kind"), s["start"].alias("start"), s["end"].alias("end"), score(s).alias("score")
            ),
        )
        return out if kind.always else F.filter(out, lambda s: s["score"] >= 0.5)

    none = F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>")
    matches = F.regexp_extract_all(text, F.lit(kind.pattern), F.lit(0))
    found = let(matches, lambda m: F.when(F.size(m) > 0, let(placed(m), scored)).otherwise(none))
    return F.when(kind.needs(text), found).otherwise(none)


def spans(text: Column, kinds=KINDS) -> Column:
    """All spans of a text, by kind in the given order, then by start; none for a null or empty text."""
    return F.coalesce(F.concat(*[_proposals(text, k) for k in kinds]), F.array().cast("array<struct<kind:string,start:int,end:int,score:double>>"))


def listed(found: Column) -> Column:
    return F.array_join(
        F.transform(found, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def redacted(text: Column, found: Column) -> Column:
    """The text with each span replaced by its kind in brackets; of overlapping spans the earlier (then longer) names it."""
    ordered = F.array_sort(F.transform(found, lambda s: F.struct(s["start"].alias("s"), (-s["end"]).alias("e"), s["kind"].alias("k"))))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, x):
        begun = x["s"] >= acc["at"]
        piece = F.substr(text, acc["at"] + 1, F.greatest(x["s"] - acc["at"], F.lit(0)))
        more = F.when(begun, F.array(piece, F.concat(F.lit("["), F.upper(x["k"]), F.lit("]")))).otherwise(
            F.array().cast("array<string>")
        )
        return F.struct(F.greatest(acc["at"], -x["e"]).alias("at"), F.concat(acc["out"], more).alias("out"))

    joined = F.aggregate(
        ordered, start, step, lambda a: F.concat(F.array_join(a["out"], ""), F.substr(text, a["at"] + 1))
    )
    return F.when(F.size(found) > 0, joined).otherwise(text)


def find(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, score). All rows and columns stay; a column of that name is replaced."""
    return docs.withColumn("spans", spans(F.col("text"), kinds))


def redact(docs: DataFrame, kinds=KINDS) -> DataFrame:
    """``docs`` with personal data replaced in ``text`` and ``n_chars`` counted anew where it changed; null stays null."""
    found = docs.withColumn("_cw_spans", spans(F.col("text"), kinds))
    found = found.withColumn("_cw_text", redacted(F.col("text"), F.col("_cw_spans")))
    hit = F.size("_cw_spans") > 0
    out = {"text": F.col("_cw_text")}
    if "n_chars" in docs.columns:
        out["n_chars"] = F.when(hit, F.length("_cw_text").cast("long")).otherwise(F.col("n_chars"))
    return found.withColumns(out).select(*docs.columns)


def report(docs: DataFrame) -> DataFrame:
    """The contract's row for every document: counts of the base kinds, a digest of their spans, and all spans."""
    found = docs.select("doc_id", spans(F.col("text")).alias("found"))
    of = lambda kind: F.size(F.filter("found", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("found", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[of(k).alias(f"n_{k}") for k in BASE_KINDS],
        F.sha2(listed(base), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


