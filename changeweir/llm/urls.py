"""URL filter: hosts are segmented into words by a unigram Viterbi search, then a multinomial naive Bayes scores the tokens.

Rules by host and path come first; what no rule fits is judged by the model. Word frequencies are counted over all
pages. Labels are weak: a URL with a word of the seed list is taken as bad, and the model learns from
all pages which other words of hosts and paths go with that. Word counts and token counts are whole tables: each
distinct part of a URL is joined with the counts of just its own substrings, each token with its own odds.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import saved, small_batches
from changeweir.llm.templates import host

# The contract's rules.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
# Words that mark a bad host.
SEEDS = frozenset(
    "adult ads adserver bet bets betting bingo casino casinos cheap dating doubleclick escort gambling jackpot loan loans "
    "lottery pharmacy pills poker porn replica sex slots spam tracker track viagra warez win xxx".split()
)
#: Weight of the model's prior.
PRIOR = 5.0
#: Parts are joined with words by their substrings up to this length, and with longer words by those words' first so many letters.
MAX_WORD = 24
#: Starts of substrings in one block of rows, so that a part of any length is taken a stretch at a time.
STARTS = 2048


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain and starts the path; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, domain, start in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host_ == domain) | host_.endswith("." + domain)) & path_.startswith(start)
        name = F.when(fits, F.lit(domain + start)).otherwise(name)
        verdict = F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


class Segmenter:
    """Splits a name into the words with the largest product of probabilities; unknown stretches, of any length, cost by length.

    ``total`` is the sum of all counts, where ``counts`` holds only those that names can need.
    """

    def __init__(self, counts: dict[str, int], total: int | None = None):
        total = (sum(counts.values()) if total is None else total) + 1.0
        self.cost = {w: math.log(total / n) for w, n in counts.items()}
        self.unknown = math.log(total) + 2.0
        self.longer = [w for w in self.cost if len(w) > MAX_WORD]

    def _longer_words(self, name: str) -> dict[int, list[int]]:
        """Starts of the words over ``MAX_WORD`` letters by their ends."""
        found: dict[int, list[int]] = {}
        for word in self.longer:
            at = name.find(word)
            while at >= 0:
                found.setdefault(at + len(word), []).append(at)
                at = name.find(word, at + 1)
        return found

    def split(self, name: str) -> list[str]:
        n = len(name)
        best, back = [0.0] + [math.inf] * n, [0] * (n + 1)
        longer = self._longer_words(name)
        # Of all unknown stretches that end here only the cheapest counts, and it is the last place's or starts there.
        stretch, begin = math.inf, 0
        for end in range(1, n + 1):
            stretch += 2.0
            if best[end - 1] + self.unknown + 2.0 < stretch:
                stretch, begin = best[end - 1] + self.unknown + 2.0, end - 1
            best[end], back[end] = stretch, begin
            for start in (*longer.get(end, ()), *range(max(0, end - MAX_WORD), end)):
                cost = best[start] + self.cost.get(name[start:end], math.inf)
                if cost < best[end] or cost == best[end] and start < back[end]:
                    best[end], back[end] = cost, start
        out, end = [], n
        while end:
            out.append(name[back[end] : end])
            end = back[end]
        return out[::-1]


def pieces(host_: str, path_: str) -> list[tuple[str, str]]:
    """(side, part) of the host's labels and the path, in order: runs of letters or of digits; the top-level domain is one."""
    labels = host_.split(".")
    found = [("h:", part) for label in labels[:-1] for part in re.findall(r"[^\W\d_]+|\d+", label)] + [("t:", labels[-1])]
    return found + [("p:", part) for part in re.findall(r"[^\W\d_]+|\d+", path_.lower())]


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's pieces: either a token (a number is ``#``) or a part that is to be split."""
    for batch in batches:
        found = [
            (uid, pos, side, part, "#" if part.isdigit() and side != "t:" else part if side == "t:" else None)
            for uid, h, p in zip(*(batch.column(c).to_pylist() for c in ("uid", "host", "path")), strict=True)
            for pos, (side, part) in enumerate(pieces(h, p))
        ]
        columns = list(zip(*found, strict=True)) or [()] * 5
        kinds = {"uid": pa.int64(), "pos": pa.int32(), "side": pa.string(), "part": pa.string(), "token": pa.string()}
        yield pa.RecordBatch.from_pydict({c: pa.array(v, kind) for (c, kind), v in zip(kinds.items(), columns, strict=True)})


def _substrings(shortest: int, longest: int, name: str = "word"):
    """Each part's number with its substrings of these lengths; distinct ones in a stretch of the part."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for pid, part in zip(batch.column("pid").to_pylist(), batch.column("part").to_pylist(), strict=True):
                n = len(part)
                for at in range(0, n, STARTS):
                    starts = range(at, min(n, at + STARTS))
                    words = list({part[i:j] for i in starts for j in range(i + shortest, min(n, i + longest) + 1)})
                    if words:
                        yield pa.RecordBatch.from_pydict({"pid": pa.array([pid] * len(words), pa.int64()), name: pa.array(words)})

    return run


def _split(total: int, seeds: dict[str, int]):
    """Each part with its words, by the counts that came with it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = batch.column("part").to_pylist()
            own = [{x["word"]: x["n"] for x in known or ()} for known in batch.column("known").to_pylist()]
            words = [Segmenter(counts | seeds, total).split(part) for part, counts in zip(parts, own, strict=True)]
            yield pa.RecordBatch.from_pydict({"part": pa.array(parts, pa.string()), "words": pa.array(words, pa.list_(pa.string()))})

    return run


def word_counts(pages: DataFrame) -> DataFrame:
    """``word, n`` of all lower-case words of all pages, counted before the shuffle."""
    words = F.explode(F.regexp_extract_all(F.lower("html"), F.lit(r"\p{L}{2,}+"), F.lit(0))).alias("word")
    return pages.select(words).groupBy("word").agg(F.count("*").alias("n"))


def split_parts(parts: DataFrame, counts: DataFrame) -> DataFrame:
    """``part, words`` for every row of ``parts(part)`` (distinct), by ``counts(word, n)``; seeds have a least count.

    A part meets the words up to ``MAX_WORD`` letters as its substrings, and longer ones by their first letters, of
    which those stay that it holds.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    found = {r.word: r.n for r in counts.where(F.col("word").isin(*SEEDS)).collect()}  # the seeds at most
    seeds = {w: max(1, total // 20_000, found.get(w, 0)) for w in SEEDS}
    total += sum(n - found.get(w, 0) for w, n in seeds.items())
    parts = saved(parts.withColumn("pid", F.monotonically_increasing_id()), "url-distinct-parts")
    short = parts.mapInArrow(_substrings(2, MAX_WORD), "pid long, word string").join(counts, "word").select("pid", "word", "n")
    long = counts.where(F.length("word") > MAX_WORD).withColumn("start", F.substring("word", 1, MAX_WORD))
    starts = parts.where(F.length("part") > MAX_WORD).mapInArrow(_substrings(MAX_WORD, MAX_WORD, "start"), "pid long, start string")
    held = starts.distinct().join(long, "start").join(parts, "pid")
    held = held.where(F.contains("part", "word")).select("pid", "word", "n")
    known = short.union(held).groupBy("pid").agg(F.collect_set(F.struct("word", "n")).alias("known"))
    return parts.join(known, "pid", "left").select("part", "known").mapInArrow(_split(total, seeds), "part string, words array<string>")


def odds(tokens: DataFrame) -> tuple[DataFrame, float]:
    """``token, odds`` (log odds of bad) of every token of ``tokens(tokens)``, and the prior's log odds.

    Counts are exact and smoothed towards the tokens' overall shares; each seed counts once as bad.
    """
    labelled = tokens.select("tokens", F.exists("tokens", lambda t: t.isin(*["h:" + w for w in SEEDS])).cast("long").alias("bad"))
    pages = labelled.agg(F.count("*").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad")).first()
    counts = labelled.select(F.explode("tokens").alias("token"), "bad").groupBy("token")
    counts = saved(counts.agg(F.sum("bad").alias("bad"), F.sum(1 - F.col("bad")).alias("good")), "url-token-counts")
    sums = counts.agg(F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"), F.coalesce(F.sum("good"), F.lit(0)).alias("good")).first()
    n_bad, n_good = sums.bad + len(SEEDS), sums.good
    bad = F.col("bad") + F.col("token").isin(*["h:" + w for w in SEEDS]).cast("long")
    prior = PRIOR * (bad + F.col("good")) / F.lit(float(n_bad + n_good))
    smooth = lambda c, n: F.log((c + prior) / F.lit(n + PRIOR))
    return counts.select("token", (smooth(bad, n_bad) - smooth(F.col("good"), n_good)).alias("odds")), math.log((pages.bad + 1) / (pages.n - pages.bad + 1))


def judge(pages: DataFrame, rules=RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict, words, score`` for every row of ``pages(page_id, url, html)``.

    A null url, or one without ``://``, has empty host and path, fits no rule and is allowed. ``words`` are the host's and
    path's tokens, ``score`` the model's log odds of bad. Dictionary and model hold every word and token; they are joined
    as tables, none is collected. Repeated rows each get their row; an empty table gives none.
    """
    small_batches(pages.sparkSession)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), host(F.col("url")).alias("host"), path(F.col("url")).alias("path"))
    rows = saved(rows.withColumn("uid", F.monotonically_increasing_id()), "url-rows")
    each = saved(rows.select("uid", "host", "path").mapInArrow(_pieces, "uid long, pos int, side string, part string, token string"), "url-pieces")
    words = split_parts(each.where("token is null").select("part").distinct(), saved(word_counts(pages), "url-words"))
    cut = each.where("token is null").join(saved(words, "url-parts"), "part")
    cut = cut.select("uid", "pos", F.transform("words", lambda w: F.concat("side", w)).alias("t"))
    ready = each.where("token is not null").select("uid", "pos", F.array(F.concat("side", "token")).alias("t"))
    tokens = cut.union(ready).groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", "t"))).alias("x"))
    tokens = saved(tokens.select("uid", F.flatten("x.t").alias("tokens")), "url-tokens")

    table, prior = odds(tokens)
    scored = tokens.select("uid", F.posexplode("tokens").alias("pos", "token")).join(table, "token")
    # Summed in the tokens' order, so that every run gives the same bits.
    scored = scored.groupBy("uid").agg(F.array_sort(F.collect_list(F.struct("pos", "odds"))).alias("x"))
    scored = scored.select("uid", F.aggregate("x.odds", F.lit(0.0), lambda a, b: a + b).alias("sum"))
    name, verdict = rule(F.col("host"), F.col("path"), rules)
    out = rows.join(tokens, "uid").join(scored, "uid").select(
        "page_id", "host", "path",
        F.when(F.col("host") == "", F.lit("")).otherwise(F.array_join(F.transform("tokens", lambda t: F.substring(t, 3, 1 << 30)), " ")).alias("words"),
        F.when(F.col("host") == "", F.lit(0.0)).otherwise(F.lit(prior) + F.col("sum")).alias("score"),
    )
    by_model = F.when(F.col("score") > 0, F.lit("block")).otherwise(F.lit("allow"))
    return out.select("page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, by_model).alias("verdict"), "words", "score")
