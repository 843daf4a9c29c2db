"""Paragraph dedup by MinHash banding: band, join, verify exact Jaccard, cluster, remove all but the first of a cluster.

A paragraph is a line of at least ``MIN_WORDS`` words, or a run of shorter lines that has as many together (``cut``).
Exact copies are one class before banding, so they meet
by digest alone. Bands are tuned for recall: with 14 bands of 3 rows a pair at Jaccard 0.8 is missed once in
20,000, at 0.85 once in 10^6, at 0.9 once in 10^8.

A passage may be shared by paragraphs that differ in the rest, or go over their ends. So each text's words, taken in a row, are also cut
into pieces at places that the words themselves choose (``places``): whoever holds the passage has the pieces inside it. They are
classes by digest like paragraphs, but take no part in banding, which their paragraphs do.
"""

from __future__ import annotations

import itertools
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import MEMBER_BITS, Minima, Words, lower_words, maybe_member, member_bits, member_place, mixed, only_members, places_for, saved, shingles, signed, small_batches
from changeweir.llm.graph import components, linked_in_buckets

BANDS, ROWS = 14, 3
#: Shorter paragraphs (a heading or list entry between long lines) stay as they are, and so do shorter runs of pieces.
MIN_WORDS = 20
#: A cut between pieces is the least of so many word pairs on either side; pieces at a text's ends with fewer words are left out.
CUT_WINDOW = 8
#: The document of rows whose doc_id is null: the first of all.
NULL_DOC = -(2**63)
#: Bytes of texts that are looked at together; each takes some 30 bytes of arrays.
BLOCK_BYTES = 1 << 20


def grouped(counts: list[int], min_words: int) -> list[list[int]]:
    """Line numbers of each paragraph of a text whose lines have so many words.

    A line with ``min_words`` words is a paragraph. Shorter lines are joined up to a blank line, a long line or the text's
    end; where neighbouring runs have too few words each, they are joined over blank lines up to the next paragraph.
    """
    found: list[list[int]] = []
    loose: list[int] = []
    run: list[int] = []
    n_loose = n_run = 0
    # The last entry stands for a long line after the end.
    for i, n in enumerate([*counts, min_words]):
        if 0 < n < min_words:
            run.append(i)
            n_run += n
            continue
        if n_run < min_words:
            loose += run
            n_loose += n_run
        if n_run >= min_words or n >= min_words:
            if n_loose >= min_words:
                found.append(loose)
            loose, n_loose = [], 0
        if n_run >= min_words:
            found.append(run)
        if n >= min_words and i < len(counts):
            found.append([i])
        run, n_run = [], 0
    return found


def cut(text: str | None, min_words: int) -> list[tuple[list[int], str]]:
    """(line numbers, text) of each paragraph of a text: its lines joined by a blank, at least ``min_words`` words."""
    lines = (text or "").split("\n")
    counts = [len(line.encode().split()) for line in lines]
    return [(p, " ".join(lines[i] for i in p)) for p in grouped(counts, min_words)]


_BLANK = np.zeros(256, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True
#: Value of each byte at each place of a word (places above 63 start over, with a factor); blanks have none.
_BYTES = mixed(np.arange(1, 64 * 256 + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)).reshape(64, 256)
_BYTES[:, _BLANK] = 0
_BYTES = _BYTES.ravel()
_STEP = np.uint64(0x9E3779B97F4A7C15)


class Worded:
    """Texts as one array of words: where each begins and ends (in bytes of all texts), its hash (A-Z lower-cased), its text."""

    def __init__(self, texts: list[str | None], hashed: bool = True):
        raws = [(t or "").encode() for t in texts]
        self.raw = b"\n".join(raws) + b"\n"  # a line end behind each text
        self.at = np.concatenate(([0], np.cumsum([len(r) + 1 for r in raws])))
        low = np.frombuffer(self.raw.lower(), np.uint8)
        blank = _BLANK[low]
        self.begin = np.flatnonzero(~blank & np.concatenate(([True], blank[:-1])))
        self.end = np.flatnonzero(blank & ~np.concatenate(([True], blank[:-1])))
        self.text = np.searchsorted(self.at, self.begin, "right") - 1
        self.line_ends = np.flatnonzero(low == 10)
        self.line = np.searchsorted(self.line_ends, self.begin)
        self.hash = self._hashes(low) if hashed else None

    def _hashes(self, low: np.ndarray) -> np.ndarray:
        if not len(self.begin):
            return np.empty(0, np.uint64)
        first = self.begin[0]
        place = np.arange(len(low) - first) - np.repeat(self.begin - first, np.diff(np.append(self.begin, len(low))))
        values = _BYTES[(place & 63) << 8 | low[first:]]
        if place.max(initial=0) > 63:
            values *= (place >> 6 << 1 | 1).astype(np.uint64)
        return mixed(np.add.reduceat(values, self.begin - first) + (self.end - self.begin).astype(np.uint64) * _STEP)

    def digests(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """(stretches, 2): 128 bits of each stretch of words ``a`` to ``b`` (stretches rise and don't overlap)."""
        if not len(a):
            return np.empty((0, 2), np.int64)
        first, n = a[0], len(self.hash)
        place = (np.arange(n - first) - np.repeat(a - first, np.diff(np.append(a, n)))).astype(np.uint64)
        bounds = np.column_stack((a, b)).ravel() - first
        out = np.empty((len(a), 2), np.uint64)
        for side, factor in enumerate((np.uint64(0xD6E8FEB86659FD93), np.uint64(0xA0761D6478BD642F))):
            values = np.append(mixed(self.hash[first:] * factor + place * _STEP), np.uint64(0))
            out[:, side] = mixed(np.add.reduceat(values, bounds)[::2] + (b - a).astype(np.uint64) * factor)
        return signed(out)

    def lines_of_paragraphs(self, min_words: int) -> Iterator[list[list[int]]]:
        """Of each text the paragraphs' line numbers, counted over all texts."""
        each = np.bincount(self.line, minlength=len(self.line_ends)).tolist()
        lines = np.searchsorted(self.line_ends, self.at)  # of each text the first
        for lo, hi in itertools.pairwise(lines.tolist()):
            yield [[lo + i for i in p] for p in grouped(each[lo:hi], min_words)]

    def paragraphs(self, min_words: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of each paragraph. Lines of a paragraph have only blank ones between them."""
        words_before = np.concatenate(([0], np.cumsum(np.bincount(self.line, minlength=len(self.line_ends)))))
        found = [p for of_text in self.lines_of_paragraphs(min_words) for p in of_text]
        a, b = [p[0] for p in found], [p[-1] + 1 for p in found]
        return words_before[np.array(a, np.int64)], words_before[np.array(b, np.int64)]

    def pieces(self, min_words: int, window: int = CUT_WINDOW) -> tuple[np.ndarray, np.ndarray]:
        """First word and end of each piece of the texts with ``min_words`` words or more, but those of ``window`` words or fewer.

        A text is cut before words whose pair with the word before has a hash that is the first least of ``window`` on either side.
        The choice looks no further, so texts that share a passage share its cuts, but for those near its ends.
        """
        n, text = len(self.hash), self.text
        if not n:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        inside = np.flatnonzero(text[1:] == text[:-1])
        x = mixed(self.hash[inside] * _STEP + self.hash[inside + 1])
        top = np.iinfo(np.uint64).max
        # Texts are kept apart by as many greatest values as a window has.
        place = np.arange(len(x)) + (text[inside] + 1) * window
        row = np.full(len(x) + (len(self.at) + 1) * window, top, np.uint64)
        row[place] = x
        have = 1
        while 2 * have <= window:
            row, have = np.minimum(row[:-have], row[have:]), 2 * have
        if have < window:
            row = np.minimum(row[: have - window], row[window - have :])
        cuts = inside[(x < row[place - window]) & (x <= row[place + 1])] + 1
        firsts = np.flatnonzero(np.concatenate(([True], text[1:] != text[:-1])))
        a = np.union1d(firsts, cuts)
        b = np.append(a[1:], n)
        long = np.bincount(text)[text[a]] >= min_words
        keep = long & (b - a > window)
        return a[keep], b[keep]


class Pieces:
    """Paragraphs of texts, then their pieces, as stretches of a text's UTF-8 bytes."""

    def __init__(self, texts: list[str | None], min_words: int):
        self.worded = w = Worded(texts)
        self.a, self.b = w.paragraphs(min_words)
        a, b = w.pieces(min_words)
        self.n_paragraphs = len(self.a)
        both = np.concatenate((self.a, a)), np.concatenate((self.b, b))
        self.rows = w.text[both[0]]
        self.start = (w.begin[both[0]] - w.at[self.rows]).astype(np.int32)
        # A piece ends where the next one of its text begins.
        goes_on = b < np.append(w.text, -1).shape[0] - 1
        goes_on[goes_on] = w.text[b[goes_on]] == w.text[a[goes_on]]
        end = w.end[both[1] - 1]
        end[self.n_paragraphs :][goes_on] = w.begin[b[goes_on]]
        self.end = (end - w.at[self.rows]).astype(np.int32)
        self.n_words = np.concatenate((np.zeros(self.n_paragraphs, np.int32), (b - a).astype(np.int32)))
        self.digests = np.concatenate((w.digests(self.a, self.b), w.digests(a, b)))

    def raw(self, i: int) -> bytes:
        at = self.worded.at[self.rows[i]]
        return self.worded.raw[at + self.start[i] : at + self.end[i]]


def _parts(batches: Iterator[pa.RecordBatch], most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches of at most ``most`` bytes of text; a longer text is one of its own."""
    for batch in batches:
        sizes, at, total = batch.column("text").to_pylist(), 0, 0
        for i, size in enumerate([len(t or "") for t in sizes]):
            if i > at and total + size > most:
                yield batch.slice(at, i - at)
                at, total = i, 0
            total += size
        if len(batch) > at:
            yield batch.slice(at)


def _least(found: Pieces, k: int, minima: Minima, words: int = 8192) -> np.ndarray:
    """(paragraphs, functions): minima of each paragraph's shingles of ``k`` words, blocks of ``words`` at a time."""
    out = np.empty((found.n_paragraphs, BANDS * ROWS), np.uint64)
    if not found.n_paragraphs:
        return out
    h = found.worded.hash
    shingle = np.full(len(h) - k + 1, k, np.uint64)
    for j in range(k):
        shingle = mixed(shingle * _STEP + h[j : len(h) - k + 1 + j])
    a, b, at = found.a, found.b - k + 1, 0
    while at < len(a):
        if b[at] - a[at] > words:
            out[at] = minima.of(shingle[a[at] : b[at]])
            at += 1
            continue
        to = max(at + 1, int(np.searchsorted(b, a[at] + words, "right")))
        block = shingle[a[at] : b[to - 1]]
        bounds = np.column_stack((a[at:to], b[at:to])).ravel()[:-1] - a[at]
        out[at:to] = minima.of_each(block, bounds)[::2]
        at = to
    return out


_KEYS = [f"k{i}" for i in range(BANDS)]


def _banded(k: int, min_words: int):
    """Paragraphs with the keys of their bands, pieces without."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        minima = Minima(BANDS * ROWS)
        salts = mixed(np.arange(1, BANDS + 1, dtype=np.uint64))
        for batch in _parts(batches):
            found = Pieces(batch.column("text").to_pylist(), min_words)
            least = _least(found, k, minima)
            keys = np.zeros((found.n_paragraphs, BANDS), np.uint64) + salts
            for row in range(ROWS):
                keys = mixed(keys * np.uint64(0x9E3779B97F4A7C15) + least[:, row::ROWS])
            no_key = pa.nulls(len(found.rows) - found.n_paragraphs, pa.int64())
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc").take(pa.array(found.rows)), "d1": found.digests[:, 0], "d2": found.digests[:, 1],
                **{c: pa.concat_arrays([pa.array(signed(np.ascontiguousarray(keys[:, i]))), no_key]) for i, c in enumerate(_KEYS)},
            })

    return run


def _chosen(min_words: int, docs_bits: bytes, bits: bytes):
    """Paragraphs and pieces whose document and digest may be among the filters', with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = (b.filter(pa.array(maybe_member(docs_bits, b.column("place").to_numpy()))) for b in batches)
        for batch in _parts(kept):
            found = Pieces(batch.column("text").to_pylist(), min_words)
            at = np.flatnonzero(maybe_member(bits, found.digests[:, 0] & (MEMBER_BITS - 1)))
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc").take(pa.array(found.rows[at])), "d1": found.digests[at, 0], "d2": found.digests[at, 1],
                "text": pa.array([found.raw(i).decode() for i in at], pa.string()),
            })

    return run


_SHARED = "doc long, tid long, start int, end int, n_words int, d1 long, d2 long"


def _placed(min_words: int, bits: bytes, n_bits: int):
    """Places of paragraphs and pieces whose digest may be among the filter's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _parts(batches):
            found = Pieces(batch.column("text").to_pylist(), min_words)
            at = np.flatnonzero(maybe_member(bits, found.digests[:, 0] & (n_bits - 1)))
            rows = pa.array(found.rows[at])
            yield pa.RecordBatch.from_pydict({
                "doc": batch.column("doc").take(rows), "tid": batch.column("tid").take(rows),
                **{c: getattr(found, c)[at] for c in ("start", "end", "n_words")},
                "d1": found.digests[at, 0], "d2": found.digests[at, 1],
            })

    return run


def copies_in(doc: int, pieces: list[dict]) -> list[dict]:
    """Those of a document's pieces that are not the first of their cluster."""
    first: dict[int, int] = {}
    for p in pieces:
        if p["first_doc"] == doc:
            first[p["cluster"]] = min(p["start"], first.get(p["cluster"], p["start"]))
    return [p for p in pieces if p["start"] != first.get(p["cluster"])]


def long_enough(pieces: list[dict], min_words: int) -> list[tuple[int, int]]:
    """Stretches of paragraphs, and of runs of pieces (each next to the one before) of ``min_words`` words or more; merged."""
    found = [(p["start"], p["end"]) for p in pieces if not p["n_words"]]
    run: list[dict] = []
    for p in [*sorted((p for p in pieces if p["n_words"]), key=lambda p: p["start"]), None]:
        if run and (p is None or p["start"] != run[-1]["end"]):
            if sum(x["n_words"] for x in run) >= min_words:
                found.append((run[0]["start"], run[-1]["end"]))
            run = []
        if p is not None:
            run.append(p)
    out: list[tuple[int, int]] = []
    for s, e in sorted(found):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def without(raw: bytes, gone: list[tuple[int, int]]) -> tuple[list[int], bytes]:
    """(lines that go whole, what is left) of a text without stretches of it (in order, apart); blank lines stay."""
    dropped, kept, at, k = [], [], 0, 0
    for number, line in enumerate(raw.split(b"\n")):
        end, parts, here = at + len(line), [], at
        while k < len(gone) and gone[k][1] <= at:
            k += 1
        for s, e in gone[k:]:
            if s >= end:
                break
            parts.append(raw[here : max(s, here)])
            here = min(e, end)
        parts.append(raw[here:end])
        left = b"".join(parts)
        if not line.strip():
            kept.append(line)
        elif left.strip():
            kept.append(left)
        else:
            dropped.append(number)
        at = end + 1
    return dropped, b"\n".join(kept)


_COLUMNS = (
    "doc long, n_paragraphs long, n_shared_words long, n_removed long, n_removed_words long, "
    "removed_lines array<int>, copies_of array<long>, kept string"
)
_KINDS = {"long": pa.int64(), "array<int>": pa.list_(pa.int32()), "array<long>": pa.list_(pa.int64()), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _COLUMNS.split(", ")])


def _finished(min_words: int, bits: bytes | None):
    """Rows without what is gone; with ``bits``, those that surely have no pieces among the filter's."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words_in = lambda raw, spans: sum(len(raw[s:e].split()) for s, e in spans)
        if bits is not None:
            batches = (b.filter(pa.array(~maybe_member(bits, b.column("place").to_numpy()))) for b in batches)
        for batch in _parts(batches):
            texts = batch.column("text").to_pylist()
            counts = [len(p) for p in Worded(texts, hashed=False).lines_of_paragraphs(min_words)]
            if bits is not None:
                none, empty = pa.array(np.zeros(len(batch), np.int64)), [[]] * len(batch)
                columns = [batch.column("doc"), pa.array(counts, pa.int64()), none, none, none, pa.array(empty, pa.list_(pa.int32()))]
                columns += [pa.array(empty, pa.list_(pa.int64())), batch.column("text")]
                yield pa.RecordBatch.from_arrays(columns, schema=_SCHEMA)
                continue
            rows = []
            for doc, text, count, pieces in zip(batch.column("doc").to_pylist(), texts, counts, batch.column("pieces").to_pylist(), strict=True):
                if not pieces:
                    rows.append((doc, count, 0, 0, 0, [], [], text))
                    continue
                raw, away = text.encode(), copies_in(doc, pieces)
                shared, gone = long_enough([p for p in pieces if p["shared"]], min_words), long_enough(away, min_words)
                lines, left = without(raw, gone)
                whole = [p for p in away if not p["n_words"]]
                inside = lambda p, spans: any(s <= p["start"] and p["end"] <= e for s, e in spans)
                spans = [(p["start"], p["end"]) for p in whole]
                of = {p["first_doc"] for p in whole} | {p["first_doc"] for p in away if inside(p, gone) and not inside(p, spans)}
                copies, n_removed = [None if x == NULL_DOC else x for x in sorted(of)], len(whole)
                rows.append((doc, count, words_in(raw, shared), n_removed, words_in(raw, gone), lines, copies, left.decode()))
            columns = zip(*rows, strict=True) if rows else [[] for _ in _SCHEMA]
            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(columns, _SCHEMA, strict=True)], schema=_SCHEMA)

    return run


def _alike(k: int, percent: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Words()
        for batch in batches:
            keep = np.zeros(len(batch), bool)
            for i, (a, b) in enumerate(zip(batch["ta"], batch["tb"], strict=True)):
                x, y = shingles(lower_words(a), k, cache), shingles(lower_words(b), k, cache)
                common = len(np.intersect1d(x, y, assume_unique=True))
                keep[i] = common * 100 >= percent * (len(x) + len(y) - common)
            yield batch.loc[keep, ["a", "b"]]

    return run


def _texts(cids: DataFrame, classes: DataFrame, docs: DataFrame, min_words: int) -> DataFrame:
    """``cid, text`` of the given classes, read again from their first documents."""
    wanted = saved(classes.join(cids, "cid").select("cid", "d1", "d2", F.col("first").alias("doc")), "paragraph-wanted")
    # Most documents and paragraphs are no candidate's: filters of fixed size drop them before they are cut and dealt out.
    bits = member_bits(wanted.select(F.col("d1").bitwiseAND(MEMBER_BITS - 1).cast("int").alias("p")), "p", MEMBER_BITS)
    texts = docs.select("doc", "text", member_place("doc").alias("place"))
    texts = texts.mapInArrow(_chosen(min_words, member_bits(wanted, "doc"), bits), "doc long, d1 long, d2 long, text string")
    found = texts.join(wanted, ["doc", "d1", "d2"]).select("cid", "text")
    return saved(found.dropDuplicates(["cid"]), "paragraph-texts")


def _verified(pairs: DataFrame, texts: Callable[[DataFrame], DataFrame], k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts reach the similarity."""
    pairs = saved(pairs, "paragraph-pairs")
    found = texts(pairs.select(F.col("a").alias("cid")).union(pairs.select("b")).distinct())
    both = pairs.join(found.withColumnsRenamed({"cid": "b", "text": "tb"}), "b")
    both = both.join(found.withColumnsRenamed({"cid": "a", "text": "ta"}), "a")
    return saved(both.select("a", "b", "ta", "tb").mapInPandas(_alike(k, percent), "a long, b long"), "paragraph-links")


def _shingled(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Words()
        for batch in batches:
            sets = [signed(shingles(lower_words(t), k, cache)) for t in batch["text"]]
            yield pd.DataFrame({"cid": batch["cid"].to_numpy(), "shingles": sets})

    return run


def clusters(docs: DataFrame, k: int = 5, percent: int = 80, min_words: int = MIN_WORDS) -> DataFrame:
    """``d1, d2, cluster, first_doc, shared``: each class of equal paragraphs or pieces of ``docs(doc, text)`` that has a copy anywhere,
    the first document of its cluster, and whether the cluster stands in several documents.

    Buckets are joined by hubs (``linked_in_buckets``): no group is cut off, and none is expanded into all its pairs.
    """
    found = docs.select("doc", "text").mapInArrow(_banded(k, min_words), "doc long, d1 long, d2 long, " + ", ".join(f"{c} long" for c in _KEYS))
    # Numbers only, so that rows meet in hash tables before they are dealt out; equal digests have equal keys.
    classes = found.groupBy("d1", "d2").agg(
        F.min("doc").alias("first"), F.max("doc").alias("last"), F.count("*").alias("n"), *[F.max(c).alias(c) for c in _KEYS]
    )
    classes = classes.where("k0 is not null or n > 1").withColumn("cid", F.monotonically_increasing_id())
    classes = saved(classes, "paragraph-classes")
    banded = classes.where("k0 is not null")
    keys = banded.select("cid", F.explode(F.array(*_KEYS)).alias("key"))
    texts = lambda cids: _texts(cids, banded, docs, min_words)
    links = linked_in_buckets(
        keys,
        lambda pairs: _verified(pairs, texts, k, percent),
        lambda cids: texts(cids).mapInPandas(_shingled(k), "cid long, shingles array<long>"),
        percent,
    )

    # A class alone at one place is nobody's copy; most are, and go before the rest is joined.
    roots = components(links, "paragraph-components")
    members = saved(roots.union(roots.select("root", "root")).distinct(), "paragraph-members")
    named = classes.drop(*_KEYS).join(members.withColumnRenamed("node", "cid"), "cid", "left")
    named = named.where("root is not null or n > 1").withColumn("cluster", F.coalesce("root", "cid"))
    named = saved(named.select("d1", "d2", "cluster", "first", "last"), "paragraph-named")
    first = named.groupBy("cluster").agg(F.min("first").alias("first_doc"), (F.min("first") < F.max("last")).alias("shared"))
    return named.select("d1", "d2", "cluster").join(first, "cluster").select("d1", "d2", "cluster", "first_doc", "shared")


def without_repeats(docs: DataFrame, k: int = 5, percent: int = 80, min_words: int = MIN_WORDS, with_text: bool = False) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``doc_id, n_paragraphs, n_shared_words, n_removed, n_removed_words, removed_lines, copies_of,
    kept_sha256`` (``kept``).

    Of each cluster of paragraphs (5-word shingles, Jaccard of 0.8 or more, linked through others), and of each class of equal
    pieces, the first place by doc_id (nulls first), then position, stays; the others go, pieces where those next to each other have
    ``min_words`` words together. A paragraph of several lines goes with all of them; blank lines stay. ``n_removed`` counts paragraphs that
    go whole, ``n_removed_words`` all words that go; ``n_shared_words`` are the words of paragraphs and passages that other documents have too,
    kept ones included. ``removed_lines`` are the numbers, from 0, of lines that go whole; ``copies_of`` the distinct doc_ids where
    the kept copies stand, the document's own included.

    Null texts count as empty: no paragraphs, nothing removed. Rows of one doc_id each get their row and lose nothing to each other; a
    null doc_id counts as the least long. An empty table gives no rows; other columns are ignored. A document's pieces meet again by
    document: at most those of one text.
    """
    small_batches(docs.sparkSession)
    doc = F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_DOC))
    docs = docs.select(doc.alias("doc"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    found = saved(clusters(docs, k, percent, min_words), "paragraph-clusters")
    # Places with a copy elsewhere are few; the rest of the work is on those alone.
    n_bits = places_for(found.count())
    bits = member_bits(found.select(F.col("d1").bitwiseAND(n_bits - 1).cast("int").alias("p")), "p", n_bits)
    rows = docs.select("doc", "text", F.xxhash64("text").alias("tid"))
    each = rows.mapInArrow(_placed(min_words, bits, n_bits), _SHARED).join(found, ["d1", "d2"])
    piece = F.struct("start", "end", "n_words", "cluster", "first_doc", "shared")
    pieces = each.groupBy(F.col("doc").alias("d"), F.col("tid").alias("t")).agg(F.collect_set(piece).alias("pieces"))
    pieces = saved(pieces, "paragraph-pieces")
    met_bits = member_bits(pieces, "t")
    plain = rows.withColumn("place", member_place("tid")).mapInArrow(_finished(min_words, met_bits), _COLUMNS)
    met = only_members(rows, met_bits, "tid").join(pieces, (F.col("tid") == F.col("t")) & (F.col("doc") == F.col("d")), "left")
    met = met.select("doc", "text", "pieces").mapInArrow(_finished(min_words, None), _COLUMNS)
    out = plain.union(met).withColumn("doc_id", F.nullif("doc", F.lit(NULL_DOC))).withColumn("kept_sha256", F.sha2("kept", 256))
    counts = ["n_paragraphs", "n_shared_words", "n_removed", "n_removed_words", "removed_lines", "copies_of"]
    return out.select("doc_id", *counts, "kept_sha256", *["kept"] * with_text)
