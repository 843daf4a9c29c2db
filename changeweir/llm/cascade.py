"""Quality rules as a short-circuit cascade, in built-in column functions only.

Each rule rejects a document. On a sample of the documents every rule is timed and its rejections are
counted; rules are then put in order of rejections per second, each next one judged on what the chosen ones
leave. The order is a ``CASE``: a document that one rule rejects is not shown to the next. The order changes
the cost and never the verdict, as the verdict is whether any rule rejects.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
#: Rows that the costs are measured on; it bounds the measuring only, every verdict is by all rules' logic.
SAMPLE_ROWS = 2000


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(WORD), F.lit(0))


def word_chars(text: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.translate(text, SPACE, "")).cast("long")


def n_symbols(text: Column) -> Column:
    return (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("long")


def n_dup_lines(text: Column) -> Column:
    """Lines with a word that equal an earlier line."""
    lines = F.filter(F.split(text, "\n"), lambda x: F.length(F.translate(x, SPACE, "")) > 0)
    return let(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long"))


def n_repeat_words(words_: Column, width: int = 3) -> Column:
    """Words inside windows of ``width`` words that occur twice or more in the text.

    Windows are compared by 64-bit hash: within a text of a million words, two different windows
    fall together once in 4 * 10^7 such texts. Equal hashes become neighbours by one sort.
    """

    def covered(hashes: Column) -> Column:
        starts = F.filter(
            hashes,
            lambda x, i: (x["h"] == F.get(hashes, i - 1)["h"]) | (x["h"] == F.get(hashes, i + 1)["h"]),
        )
        starts = F.array_sort(F.transform(starts, lambda x: x["i"]))
        step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(width), i - acc["last"])).alias("n"))
        return F.aggregate(starts, F.struct(F.lit(-width).alias("last"), F.lit(0).alias("n")), step, lambda a: a["n"])

    def hashed(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - width)
        return F.transform(at, lambda i: F.xxhash64(*[F.get(w, i + j) for j in range(width)]))

    def counted(h: Column) -> Column:
        pairs = F.array_sort(F.transform(h, lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(let(pairs, covered))

    return F.when(F.size(words_) < width, F.lit(0)).otherwise(let(hashed(words_), counted)).cast("long")


@dataclass(frozen=True)
class Measures:
    """What rules look at; a measure that the rows already carry as a column is taken from there."""

    text: Column
    words: Column
    known: Mapping[str, Column] = field(default_factory=dict)

    def _of(self, name: str, make: Callable[[], Column]) -> Column:
        return self.known[name] if name in self.known else make()

    @property
    def n_words(self) -> Column:
        return self._of("n_words", lambda: F.size(self.words))

    @property
    def word_chars(self) -> Column:
        return self._of("word_chars", lambda: word_chars(self.text))

    @property
    def n_symbols(self) -> Column:
        return self._of("n_symbols", lambda: n_symbols(self.text))

    @property
    def n_lines(self) -> Column:
        return F.length(self.text) - F.length(F.translate(self.text, "\n", "")) + 1

    @property
    def n_dup_lines(self) -> Column:
        return self._of("n_dup_lines", lambda: n_dup_lines(self.text))

    @property
    def n_repeat_words(self) -> Column:
        return self._of("n_repeat_words", lambda: n_repeat_words(self.words))

    @property
    def n_capitals(self) -> Column:
        return F.length(F.regexp_replace(self.text, r"[^\p{Lu}]+", ""))


@dataclass(frozen=True)
class Rule:
    """``reject`` takes the measures of a text and is true where the document goes; null counts as not rejected."""

    name: str
    reject: Callable[[Measures], Column]


#: The base of the contract (too few words; too many repeated ones) and the further rules' limits.
RULES = (
    Rule("few_words", lambda m: m.n_words < 50),
    Rule("repeated_words", lambda m: m.n_repeat_words * 100 > m.n_words * 50),
    Rule("symbols", lambda m: m.n_symbols * 100 > m.n_words * 30),
    Rule("duplicate_lines", lambda m: m.n_dup_lines * 100 > m.n_lines * 50),
    Rule("word_length", lambda m: (m.word_chars > m.n_words * 15) | (m.word_chars < m.n_words * 2)),
    Rule("capitals", lambda m: m.n_capitals * 2 > m.word_chars),
)


@dataclass(frozen=True)
class Estimate:
    name: str
    seconds: float
    rejected: int


def plan_cascade(docs: DataFrame, rules=RULES, rows: int = SAMPLE_ROWS, seed: int = 7) -> list[Estimate]:
    """The rules in the order to try them, with cost and rejections on a sample of ``docs(text)``.

    Cost is the time of one pass over the sample, less that of a pass without a rule. The greedy order takes the rule
    with most rejections per second among the documents that are left. An empty table keeps the given order.
    """
    total = docs.count()
    if not total:
        return [Estimate(r.name, 0.0, 0) for r in rules]
    fraction = min(1.0, rows * 1.2 / total)
    sample = docs.select(F.coalesce("text", F.lit("")).alias("text")).sample(fraction, seed).limit(rows)
    sample = sample.withColumn("words", words(F.col("text"))).persist()
    measures = Measures(F.col("text"), F.col("words"))
    hit = {r.name: F.coalesce(r.reject(measures), F.lit(False)) for r in rules}
    flags = sample.select(*[c.alias(n) for n, c in hit.items()])

    def timed(df: DataFrame) -> float:
        began = time.perf_counter()
        df.agg(F.sum(F.col("x").cast("int"))).collect()
        return time.perf_counter() - began

    # Every combination of verdicts that occurs, with its count: at most 2 ** rules rows.
    seen = [(r.asDict(), r["n"]) for r in flags.groupBy(*hit).agg(F.count("*").alias("n")).collect()]
    nothing = timed(sample.select((F.size("words") < 0).alias("x")))
    cost = {n: max(1e-3, timed(sample.select(c.alias("x"))) - nothing) for n, c in hit.items()}
    sample.unpersist()
    order, left = [], list(hit)
    while left:
        gone = {n: sum(k for v, k in seen if v[n] and not any(v[o.name] for o in order)) for n in left}
        best = max(left, key=lambda n: gone[n] / cost[n])
        order.append(Estimate(best, cost[best], gone[best]))
        left.remove(best)
    return order


def first_rejection(measures: Measures, order: list[Estimate], rules=RULES) -> Column:
    """Name of the first rule in ``order`` that rejects, else null. Later rules are then not evaluated."""
    by_name, out = {r.name: r for r in rules}, None
    for e in order:
        test = by_name[e.name].reject(measures)
        out = F.when(test, F.lit(e.name)) if out is None else out.when(test, F.lit(e.name))
    return out


def judged(docs: DataFrame, rules=RULES) -> DataFrame:
    """``docs`` with ``rejected_by`` (null where kept); all rows and columns stay.

    A null text is judged as an empty one, which has no words and so is rejected. Repeated rows get the
    same verdict. A column of ``docs`` called ``rejected_by`` is replaced.
    """
    order = plan_cascade(docs, rules)
    text = F.coalesce("text", F.lit(""))
    return docs.withColumn("rejected_by", let(words(text), lambda w: first_rejection(Measures(text, w), order, rules)))


def kept_only(docs: DataFrame, rules=RULES) -> DataFrame:
    """The rows that no rule rejects, with their columns."""
    return judged(docs, rules).where("rejected_by is null").select(*docs.columns)


def statistics(docs: DataFrame) -> DataFrame:
    """The contract's base columns for every row, and ``kept`` by the cascade; null text as empty."""
    order = [e for e in plan_cascade(docs) if e.name not in ("few_words", "repeated_words")]
    text = F.coalesce("text", F.lit(""))
    found = docs.select("doc_id", text.alias("text"), words(text).alias("words"))
    found = found.select(
        "doc_id",
        "text",
        "words",
        F.size("words").cast("long").alias("n_words"),
        word_chars(F.col("text")).alias("word_chars"),
        n_symbols(F.col("text")).alias("n_symbols"),
        n_dup_lines(F.col("text")).alias("n_dup_lines"),
        n_repeat_words(F.col("words")).alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < 50) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 50)
    # Referred to twice, as output and by a rule, each measure is computed once: Catalyst keeps the two projections apart.
    known = {c: F.col(c) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")}
    measures = Measures(F.col("text"), F.col("words"), known)
    verdict = F.when(failed, F.lit("base")).otherwise(first_rejection(measures, order))
    return found.select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        verdict.isNull().alias("kept"),
    )
