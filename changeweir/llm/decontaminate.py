"""Benchmark decontamination by a generalised suffix automaton over the items' words.

The automaton holds every run of words of every item. A document's words are streamed through it; the
longest run that ends at each word is tracked, so that a run of ``window`` words or more marks those words.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from changeweir.llm.common import small_batches


#: Bytes of benchmark text of one automaton (some 100 MB in each Python worker). A larger benchmark is split by item into parts, whose
#: automata the documents go through one after another.
PART_BYTES = 1024 * 1024

#: Bytes that are not part of words (A-Z are lower-cased before), as blanks.
_KEPT = set(range(0x30, 0x3A)) | set(range(0x61, 0x7B)) | set(range(0x80, 0x100))
_BLANKED = bytes(b if b in _KEPT else 0x20 for b in range(256))


def item_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``, A-Z lower-cased; null has none."""
    return text.encode().lower().translate(_BLANKED).split() if text else []


class SuffixAutomaton:
    """States are classes of runs of words with the same ends; ``items`` names who has the runs of a state."""

    def __init__(self):
        self.step: list[dict[bytes, int]] = [{}]
        self.link: list[int] = [-1]
        self.length: list[int] = [0]
        self.owners: list[set] = [set()]
        self.whole: list[list] = [[]]  # items shorter than a window that are just this state's run of that length

    def _state(self, length: int, step: dict, link: int) -> int:
        self.step.append(step)
        self.link.append(link)
        self.length.append(length)
        self.owners.append(set())
        self.whole.append([])
        return len(self.length) - 1

    def _split(self, at: int, word: bytes, target: int) -> int:
        """A copy of ``target`` for its runs up to one longer than those of ``at``."""
        copy = self._state(self.length[at] + 1, dict(self.step[target]), self.link[target])
        while at >= 0 and self.step[at].get(word) == target:
            self.step[at][word] = copy
            at = self.link[at]
        self.link[target] = copy
        return copy

    def add(self, words: list[bytes]) -> list[int]:
        """Adds one item's words; returns the state after each."""
        last, path = 0, []
        for word in words:
            at, known = last, self.step[last].get(word)
            if known is not None:
                last = known if self.length[known] == self.length[last] + 1 else self._split(last, word, known)
            else:
                new = self._state(self.length[last] + 1, {}, 0)
                while at >= 0 and word not in self.step[at]:
                    self.step[at][word] = new
                    at = self.link[at]
                if at >= 0:
                    target = self.step[at][word]
                    self.link[new] = target if self.length[target] == self.length[at] + 1 else self._split(at, word, target)
                last = new
            path.append(last)
        return path

    def after(self, words: list[bytes]) -> Iterator[tuple[int, int]]:
        """(state, length) of the longest run that ends at each word of an item's own text."""
        at = n = 0
        for word in words:
            while at and word not in self.step[at]:
                at = self.link[at]
                n = self.length[at]
            if word in self.step[at]:
                at, n = self.step[at][word], n + 1
            yield at, n


class Benchmark:
    """The automaton of all items, and who owns the windows that end in a state."""

    def __init__(self, items: list[tuple[object, str | None]], window: int):
        self.window, self.automaton = window, SuffixAutomaton()
        worded = [(item, item_words(text)) for item, text in items]
        for _, words in worded:
            self.automaton.add(words)
        a = self.automaton
        # Splitting moves runs to other states, so owners are written when all items are in.
        for item, words in worded:
            for at, n in a.after(words):
                if n >= window:
                    a.owners[self.floor(at, window)].add(item)
            if 0 < len(words) < window:
                at, _n = list(a.after(words))[-1]
                a.whole[self.floor(at, len(words))].append((len(words), item))
        # The next state along the links, itself included, at which a short item ends; -1 for none.
        self.short = [-1] * len(a.link)
        for s in sorted(range(1, len(a.link)), key=a.length.__getitem__):
            self.short[s] = s if a.whole[s] else self.short[a.link[s]]
        # The state that holds the window of a state's runs.
        self.ending = [self.floor(s, window) if a.length[s] >= window else 0 for s in range(len(a.link))]

    def floor(self, at: int, n: int) -> int:
        """The state of the last ``n`` words of a state's runs."""
        a = self.automaton
        while a.length[a.link[at]] >= n:
            at = a.link[at]
        return at

    def hits(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set]:
        """Runs of hit words as merged (start, end), and the items whose windows occur."""
        a, window, short, ending = self.automaton, self.window, self.short, self.ending
        step, link, length = a.step, a.link, a.length
        spans: list[tuple[int, int]] = []
        found: set = set()

        def mark(start: int, end: int) -> None:
            while spans and spans[-1][1] >= start:
                start = min(start, spans.pop()[0])
            spans.append((start, end))

        at = n = 0
        for i, word in enumerate(words, 1):
            to = step[at].get(word)
            while to is None and at:
                at = link[at]
                n = length[at]
                to = step[at].get(word)
            if to is None:
                continue
            at, n = to, n + 1
            if n >= window:
                # Runs shorter than a state's least length never stand here: n lies within the state.
                mark(i - window, i)
                found |= a.owners[ending[at]]
            s = short[at]
            while s > 0:
                for size, item in a.whole[s]:
                    if size <= n:
                        mark(i - size, i)
                        found.add(item)
                s = short[link[s]]
        return spans, found


def item_parts(benchmark: DataFrame, part_bytes: int | None = None) -> Iterator[list[tuple[object, str | None]]]:
    """The benchmark's rows in parts of about ``part_bytes``, dealt by hash; one part is collected at a time by who iterates."""
    size = benchmark.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, -(-size // (part_bytes or PART_BYTES)))
    part = F.pmod(F.xxhash64(F.col("item_id").cast("string"), "text"), F.lit(count))
    rows = benchmark.select("item_id", "text", part.alias("part"))
    for k in range(count):
        yield [(r[0], r[1]) for r in rows.where(F.col("part") == k).select("item_id", "text").collect()]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


_SPANS = ArrayType(StructType([StructField("s", IntegerType()), StructField("e", IntegerType())]))


def _hits(shared, built: list[Benchmark], batch: pd.DataFrame) -> Iterator[tuple[list[tuple[int, int]], list[str]]]:
    """(runs of hit words, ids of items that occur, null ids left out) of each row, with those that the row brings along."""
    if not built:  # once in each worker, from broadcast items
        built.append(Benchmark(*shared.value))
    known = "_cw_spans" in batch
    for i, text in enumerate(batch["text"]):
        spans, found = built[0].hits(item_words(text))
        names = {str(x) for x in found if x is not None}
        if known and batch["_cw_spans"].iloc[i] is not None:
            spans = merged([(x["s"], x["e"]) for x in batch["_cw_spans"].iloc[i]] + spans)
            names.update(batch["_cw_items"].iloc[i])
        yield spans, sorted(names)


def through_parts(docs: DataFrame, benchmark: DataFrame, window: int, last, schema) -> DataFrame:
    """``last(hits)``, a function on batches, over ``docs``; ``hits`` gives a batch's hits with all of the benchmark.

    Nothing is shuffled. A benchmark of several parts costs as many passes over the documents' words, each with the runs that the
    ones before it have found, and never more memory than its automata one by one in a worker of each.
    """
    small_batches(docs.sparkSession)
    context = docs.sparkSession.sparkContext
    *before, end = [context.broadcast((items, window)) for items in item_parts(benchmark)]
    fields = StructType([*docs.schema.fields, StructField("_cw_spans", _SPANS), StructField("_cw_items", ArrayType(StringType()))])

    def one_part(shared):
        built: list[Benchmark] = []

        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                found = list(_hits(shared, built, batch))
                batch["_cw_spans"] = [[{"s": s, "e": e} for s, e in spans] for spans, _ in found]
                batch["_cw_items"] = [items for _, items in found]
                yield batch

        return run

    for shared in before:
        docs = docs.mapInPandas(one_part(shared), fields)
    built: list[Benchmark] = []
    return docs.mapInPandas(last(lambda batch: _hits(end, built, batch)), schema)


def report(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The contract's row for every document; nothing is shuffled.

    Null and empty texts have no words and no hits; repeated rows each get their row; item ids that repeat count once,
    null item ids not at all (their windows still mark words). An empty benchmark hits nothing.
    """

    def last(hits):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                rows = []
                for doc_id, text, (spans, items) in zip(batch["doc_id"], batch["text"], hits(batch), strict=True):
                    digest = hashlib.sha256(",".join(items).encode()).hexdigest()
                    hit = sum(e - s for s, e in spans)
                    rows.append((doc_id, len(item_words(text)), hit, len(items), digest, hit > 0))
                out = pd.DataFrame(rows, columns=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])
                out["doc_id"] = out["doc_id"].astype("Int64")
                yield out

        return run

    schema = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"
    return through_parts(docs.select("doc_id", "text"), benchmark, window, last, schema)


def cut_text(text: str, spans: list[tuple[int, int]]) -> str:
    """``text`` without the words of the spans, from the first byte of a span's first word to the last of its last."""
    raw = text.encode()
    blanked = np.frombuffer(raw.lower().translate(_BLANKED), np.uint8) != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate(([0], blanked.view(np.int8), [0]))))
    starts, ends = edges[::2], edges[1::2]
    out, at = [], 0
    for s, e in spans:
        out.append(raw[at : starts[s]])
        at = ends[e - 1]
    out.append(raw[at:])
    return b"".join(out).decode()


def cleaned(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5) -> DataFrame:
    """Documents without benchmark runs: hit words are cut; a document with more than ``max_coverage`` of its words hit goes.

    All columns stay; ``n_chars`` follows the cut text where there is such a column. Null texts stay as they are.
    """
    columns = docs.columns

    def last(hits):
        def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for batch in batches:
                keep = np.ones(len(batch), bool)
                found = list(hits(batch))
                texts, sizes = batch["text"].tolist(), batch["_cw_len"].tolist()
                for i, (spans, _) in enumerate(found):
                    if spans:
                        keep[i] = sum(e - s for s, e in spans) <= max_coverage * len(item_words(texts[i]))
                        texts[i] = cut_text(texts[i], spans)
                        sizes[i] = len(texts[i])
                batch["text"], batch["_cw_len"] = texts, pd.array(sizes, dtype="Int64")
                yield batch[keep].drop(columns=["_cw_spans", "_cw_items"], errors="ignore")

        return run

    size = F.col("n_chars").cast("long") if "n_chars" in columns else F.lit(None).cast("long")
    sized = docs.withColumn("_cw_len", size)
    out = through_parts(sized, benchmark, window, last, sized.schema)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.col("_cw_len").cast(docs.schema["n_chars"].dataType))
    return out.select(*columns)
