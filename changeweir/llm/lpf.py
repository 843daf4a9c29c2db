"""Exact substring dedup by longest-previous-factor arrays of small suffix arrays.

A repeat of ``length`` bytes shares its least gram (by hash, leftmost on ties) with all its copies, at
the same place. Grams are a quarter as long as repeats: texts that share less than a gram never meet. So each start of a ``length``-byte string belongs to one *anchor*, and equal strings belong to
anchors with equal grams. Anchors are grouped in Spark; a group's text is the few hundred bytes that its starts cover.
In each group's suffix array, the previous and next smaller positions give every start its longest earlier match.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import maybe_member, member_bits, mixed, only_members, places_for, signed, small_batches
from changeweir.llm.common import saved as written

#: Bytes of a gram: so many, or this share of a repeat's length if that is more. Any width finds every repeat; wider grams bring
#: fewer texts together that share only a phrase, and leave more anchors.
GRAM, GRAM_SHARE = 32, 0.24
#: Groups of more different texts and bytes than this are counted string by string in Spark instead of in one suffix array.
GROUP_TEXTS, GROUP_BYTES = 64, 300_000
#: Bytes of group texts that share one suffix array (whole groups, each of at most GROUP_TEXTS short texts or GROUP_BYTES).
BATCH_BYTES = 400_000

_BYTE = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_FACTORS = mixed(np.arange(301, 340, dtype=np.uint64)) | np.uint64(1)


#: Shuffle files of a query go when it ends, instead of when the driver next collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written and read again; what its query shuffled is not kept on disk beside it."""
    conf = df.sparkSession.conf
    before = conf.get(CLEANUP, None)
    conf.set(CLEANUP, "true")
    try:
        return written(df, label)
    finally:
        conf.unset(CLEANUP) if before is None else conf.set(CLEANUP, before)


def gram_width(length: int) -> int:
    return max(min(GRAM, length), int(length * GRAM_SHARE))


def hashes(raw: np.ndarray, width: int) -> np.ndarray:
    """64-bit hash of every ``width``-byte string, by doubling."""
    h, have = _BYTE[raw], 1
    at, level = 0, 0
    out = None
    # The width's binary digits, smallest first: what has been put together so far precedes the next power.
    while True:
        if width & have:
            if out is None:
                out = h
            else:
                n = len(raw) - at - have + 1
                out = mixed(out[:n] * _FACTORS[20 + level] + h[at : at + n])
            at += have
        if 2 * have > width:
            break
        h = h[:-have] * _FACTORS[level] + h[have:]
        have, level = 2 * have, level + 1
    return mixed(out)


#: Low bits of an ordered hash that hold the place, and bytes that are looked at in one piece (far fewer than 2^24).
_PLACE_BITS, _PIECE = 24, 1 << 22


def anchors(raw: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(gram hash, first start, end of starts) of every anchor, in order; none for texts shorter than ``length``.

    Grams are ordered by 40 bits of their hash, then by place, so one minimum over a window names its
    gram. Long texts are looked at in pieces that overlap by ``length`` - 1; starts are dealt to pieces once.
    """
    return anchors_and_grams(raw, length)[:3]


def anchors_and_grams(raw: bytes, length: int, shorter: int | None = None) -> tuple[np.ndarray, ...]:
    """The anchors, and (gram hash, place) of the least gram of every string of ``shorter`` bytes, those of anchors included."""
    found = [(at, _anchors_of_piece(raw[at : at + _PIECE + length - 1], length, shorter or length)) for at in range(0, max(len(raw), 1), _PIECE)]
    columns = zip(*[(g, f + at, e + at, h, p + at) for at, (g, f, e, h, p) in found], strict=True)
    return tuple(np.concatenate(c) for c in columns)


def _minima(values: np.ndarray, window: int) -> np.ndarray:
    n, have = len(values), 1
    while 2 * have <= window:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[: n - window + 1], values[window - have :])


def _anchors_of_piece(raw: bytes, length: int, shorter: int) -> tuple[np.ndarray, ...]:
    none = np.empty(0, np.int64)
    if len(raw) < shorter:
        return none.view(np.uint64), none, none, none.view(np.uint64), none
    width = gram_width(length)
    grams = hashes(np.frombuffer(raw, np.uint8), width)
    low = np.uint64((1 << _PLACE_BITS) - 1)
    least = _minima((grams & ~low) | np.arange(len(grams), dtype=np.uint64), shorter - width + 1)
    places = (least[np.concatenate(([True], least[1:] != least[:-1]))] & low).astype(np.int64)
    if len(raw) < length:
        return none.view(np.uint64), none, none, grams[places], places
    value = _minima(least, length - shorter + 1)
    first = np.flatnonzero(np.concatenate(([True], value[1:] != value[:-1])))
    return grams[(value[first] & low).astype(np.int64)], first, np.concatenate((first[1:], [len(value)])), grams[places], places


def ranks_by_prefix(codes: np.ndarray, length: int) -> np.ndarray:
    """Ranks of all suffixes by their first ``length`` symbols (from 1), by prefix doubling; the end sorts first.

    A rank is the number of the first place in suffix order that its prefix has, so a round needs to look only at those suffixes
    that still share theirs. The first round takes as many symbols as one number holds.
    """
    n = len(codes)
    if not n:
        return np.empty(0, np.int64)
    bits = int(codes.max() + 1).bit_length()
    have = max(1, min(63 // bits, length))
    padded = np.concatenate((codes + 1, np.zeros(have, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(have):
        key = key << bits | padded[j : j + n]
    rank, todo = np.ones(n, np.int64), np.arange(n)
    while True:
        order = np.argsort(key)
        todo, key = todo[order], key[order]
        old = rank[todo]
        new_group = np.concatenate(([True], key[1:] != key[:-1]))
        old_group = np.concatenate(([True], old[1:] != old[:-1]))
        place = np.arange(len(todo))
        start = np.maximum.accumulate(np.where(new_group, place, 0))
        rank[todo] = old + start - np.maximum.accumulate(np.where(old_group, place, 0))
        sizes = np.diff(np.append(np.flatnonzero(new_group), len(todo)))
        todo = todo[np.repeat(sizes > 1, sizes)]
        if have >= length or not len(todo):
            return rank
        step = min(have, length - have)  # the last step may overlap what is ranked already
        have += step
        behind = todo + step
        key = rank[todo] * (n + 1) + np.where(behind < n, rank[np.minimum(behind, n - 1)], 0)


def previous_smaller(order: np.ndarray) -> np.ndarray:
    """For each entry the index of the nearest one before it that is smaller; -1 if none. Pointers jump over pointers."""
    before = np.arange(-1, len(order) - 1)
    todo = np.flatnonzero((before >= 0) & (order[before] > order))
    while len(todo):
        before[todo] = before[before[todo]]
        todo = todo[(before[todo] >= 0) & (order[before[todo]] > order[todo])]
    return before


def longest_previous(codes: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """For every position an earlier one that shares its next ``length`` symbols, before and after it in suffix order.

    Of all earlier positions, the previous and next smaller ones in suffix order share the longest prefix, so the
    longest previous factor reaches ``length`` where either of them does; -1 where not.
    """
    rank = ranks_by_prefix(codes, length)
    order, n = np.argsort(rank), len(codes)
    whole = np.arange(n) + length <= n
    source = np.full((2, n), -1, np.int64)
    for row, turn in ((0, 1), (1, -1)):
        entries = order[::turn]
        at = previous_smaller(entries)
        before = entries[at]
        source[row, entries] = np.where((at >= 0) & (rank[before] == rank[entries]) & whole[entries], before, -1)
    return source[0], source[1]


def runs(flags: np.ndarray) -> np.ndarray:
    """(start, end) of each run of true values."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], flags.view(np.int8), [0]))))
    return edges.reshape(-1, 2)


def _place_of(tid: bytes, first: np.ndarray) -> np.ndarray:
    """One 64-bit number for (text, first start)."""
    return signed(mixed(np.uint64(int.from_bytes(tid[:8], "little")) ^ mixed(first.astype(np.uint64) + np.uint64(1))))


def _grams(length: int, shorter: int | None):
    """Each text's distinct grams, with the number of anchors there that have them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            grams, counts = [np.empty(0, np.uint64)], [np.empty(0, np.int64)]
            for text in batch.column("text").to_pylist():
                if len(text) * 4 < (shorter or length):
                    continue
                gram, _, _, every, _ = anchors_and_grams(text.encode(), length, shorter)
                grams.append(np.unique(every))
                counts.append(np.bincount(np.searchsorted(grams[-1], gram), minlength=len(grams[-1])))
            yield pa.RecordBatch.from_pydict({"gram": signed(np.concatenate(grams)), "n": np.concatenate(counts)})

    return run


def _text_key(tid: bytes) -> int:
    """64 bits of a text's digest."""
    return int.from_bytes(tid[:8], "big", signed=True)


def _anchored(length: int, bits: bytes, n_bits: int, shorter: int | None, shared_bits: bytes, n_shared_bits: int):
    """Anchors whose gram may be among the filter's; then, without chunk, the grams that other texts may have too."""
    types = {
        "doc_id": pa.int64(), "tid": pa.binary(), "gram": pa.int64(), "chunk": pa.binary(), "first": pa.int32(), "end": pa.int32(), "rid": pa.int64(),
        "t": pa.int64(), "place": pa.int32(),
    }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in types]
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
                raw = text.encode()
                gram, first, end, every, places = anchors_and_grams(raw, length, shorter)
                at = np.flatnonzero(maybe_member(bits, signed(gram) & (n_bits - 1)))
                noted = np.flatnonzero(maybe_member(shared_bits, signed(every) & (n_shared_bits - 1))) if shorter else at[:0]
                if not len(at) and not len(noted):
                    continue
                tid = hashlib.md5(raw, usedforsecurity=False).digest()
                rid = _place_of(tid, first)
                chunks = [xxhash.xxh3_128_digest(raw[s : e + length - 1]) for s, e in zip(first[at].tolist(), end[at].tolist(), strict=True)]
                n, m = len(at), len(noted)
                rows = (
                    [doc_id] * n + [None] * m, [tid] * n + [None] * m, signed(gram)[at].tolist() + signed(every)[noted].tolist(), chunks + [None] * m,
                    first[at].tolist() + [None] * m, end[at].tolist() + [None] * m, rid[at].tolist() + [None] * m,
                    [None] * n + [_text_key(tid)] * m, [None] * n + places[noted].tolist(),
                )
                for column, values in zip(out, rows, strict=True):
                    column += values
            yield pa.RecordBatch.from_pydict({c: pa.array(v, t) for (c, t), v in zip(types.items(), out, strict=True)})

    return run


def _contents(length: int, bits: bytes, n_bits: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                raw = text.encode()
                _, first, end = anchors(raw, length)
                if not len(first):
                    continue
                rid = _place_of(hashlib.md5(raw, usedforsecurity=False).digest(), first)
                for k in np.flatnonzero(maybe_member(bits, rid & (n_bits - 1))):
                    rows.append((int(rid[k]), raw[first[k] : end[k] + length - 1]))
            yield pd.DataFrame(rows, columns=["rid", "content"])

    return run


def _intervals(flags: np.ndarray) -> list[dict]:
    return [{"s": int(s), "e": int(e)} for s, e in runs(flags)]


def _matched(length: int):
    """Groups of texts (sorted by group, then corpus order) to the starts that have copies, and earlier copies."""

    def solve(group: pd.DataFrame) -> pd.DataFrame:
        parts, starts, at = [], [], 0
        for k, raw in enumerate(group["content"]):
            starts.append(at)
            parts += [np.frombuffer(raw, np.uint8).astype(np.int64), np.array([256 + k])]  # a separator of its own
            at += len(raw) + 1
        before, after = longest_previous(np.concatenate(parts), length)
        later = (before >= 0) | (after >= 0)
        any_copy = later.copy()
        for source in (before, after):
            any_copy[source[source >= 0]] = True
        ends = [s + len(r) - length + 1 for s, r in zip(starts, group["content"], strict=True)]
        return pd.DataFrame({
            "gram": group["gram"].to_numpy(), "chunk": group["chunk"].to_numpy(),
            "copied": [_intervals(any_copy[s:e]) for s, e in zip(starts, ends, strict=True)],
            "later": [_intervals(later[s:e]) for s, e in zip(starts, ends, strict=True)],
        })

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []
        size = 0
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                held.append(part)
                size += int(part["content"].str.len().sum())
                if size >= BATCH_BYTES:
                    rows = pd.concat(held, ignore_index=True)
                    last = rows["gram"].iloc[-1]
                    whole = rows["gram"] != last  # the last group may go on
                    if whole.any():
                        yield solve(rows[whole])
                    held = [rows[~whole]]
                    size = int(held[0]["content"].str.len().sum())
        rows = pd.concat(held, ignore_index=True) if held else None
        if rows is not None and len(rows):
            yield solve(rows)

    return run


def _strings(length: int):
    """Every start of a text with two 64-bit hashes of its string: for groups with very many texts."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.iloc[at : at + 256]
                texts = [np.frombuffer(raw, np.uint8) for raw in part["content"]]
                one = [hashes(a, length) for a in texts]
                two = [hashes(a ^ np.uint8(0x5A), length) for a in texts]
                sizes = [len(x) for x in one]
                columns = {c: np.repeat(part[c].to_numpy(), sizes) for c in ("gram", "chunk")}
                places = np.concatenate([np.arange(n) for n in sizes])
                yield pd.DataFrame(columns | {"at": places, "h1": signed(np.concatenate(one)), "h2": signed(np.concatenate(two))})

    return run


_SPANS = "array<struct<s:int,e:int>>"


def repeats(docs: DataFrame, length: int = 400) -> DataFrame:
    """``doc_id, tid, copied, later`` for the texts of ``docs(doc_id, text)`` that have repeats.

    ``tid`` is the MD5 of the text. ``copied`` holds runs of starts (byte positions, end exclusive) whose string of ``length`` bytes
    also starts elsewhere, in whatever document; ``later`` those of which an earlier copy exists, in the order of doc_id
    (nulls first), text digest, position. Runs may touch or overlap. Rows with the same doc_id and text have the same order.
    """
    return _repeats(docs, length, None)[0]


def _shared(found: DataFrame, grams: DataFrame, width: int) -> DataFrame:
    """``t, n_shared``: bytes of each text that lie in grams of other texts. ``t`` are 64 bits of its digest."""
    notes = found.where("chunk is null").select("t", "gram", "place").join(grams, "gram")
    places = notes.groupBy("t").agg(F.array_sort(F.collect_set("place")).alias("p"))
    steps = f"zip_with(slice(p, 2, size(p) - 1), slice(p, 1, size(p) - 1), (x, y) -> least(x - y, {width}))"
    return places.selectExpr("t", f"aggregate({steps}, {width}L, (s, x) -> s + x) AS n_shared")


def _repeats(docs: DataFrame, length: int, shorter: int | None) -> tuple[DataFrame, DataFrame | None]:
    """The repeats, and with ``shorter`` the texts with grams of others."""
    docs = docs.select("doc_id", "text").where("text is not null")
    # Most grams stand at one place in the corpus. They are counted as bare numbers and go before anything is written or dealt out.
    grams = docs.select("text").mapInArrow(_grams(length, shorter), "gram long, n long").groupBy("gram")
    grams = grams.agg((F.sum("n") > 1).alias("again"), (F.count("*") > 1).alias("shared"))
    grams = saved(grams.where("again OR shared" if shorter else "again"), "lpf-grams")

    def bits_of(rows: DataFrame) -> tuple[bytes, int]:
        n_bits = places_for(rows.count())
        return member_bits(rows.select(F.expr(f"cast(gram & {n_bits - 1} as int)").alias("p")), "p", n_bits), n_bits

    bits, shared_bits = bits_of(grams.where("again")), bits_of(grams.where("shared")) if shorter else (b"", 0)
    schema = "doc_id long, tid binary, gram long, chunk binary, first int, end int, rid long, t long, place int"
    every = saved(docs.mapInArrow(_anchored(length, *bits, shorter, *shared_bits), schema), "lpf-anchors")
    shared = saved(_shared(every, grams.where("shared").select("gram"), gram_width(length)), "lpf-shared-grams") if shorter else None
    found = every.where("chunk is not null")
    chunks = found.groupBy("gram", "chunk").agg(
        F.count("*").alias("n"),
        F.min(F.struct("doc_id", "tid", "first", "rid", F.col("end").alias("end"))).alias("ref"),
    )
    chunks = saved(chunks, "lpf-chunks")
    size = F.col("ref.end") - F.col("ref.first") + (length - 1)
    grams = chunks.groupBy("gram").agg(F.sum("n").alias("total"), F.count("*").alias("texts"), F.sum(size).alias("bytes")).where("total > 1")
    met = saved(chunks.join(grams, "gram"), "lpf-shared")

    # Texts of the groups with different texts: one copy of each.
    mixed_up = met.where("texts > 1").select("gram", "chunk", "texts", "bytes", "ref", F.col("ref.rid").alias("rid"))
    n_bits = places_for(mixed_up.count())
    bits = member_bits(mixed_up.select(F.expr(f"cast(rid & {n_bits - 1} as int)").alias("p")), "p", n_bits)
    content = docs.select("text").mapInPandas(_contents(length, bits, n_bits), "rid long, content binary")
    texts = saved(mixed_up.join(content.dropDuplicates(["rid"]), "rid").drop("rid"), "lpf-texts")
    order = ["gram", "ref.doc_id", "ref.tid", "ref.first"]
    many = (F.col("texts") > GROUP_TEXTS) & (F.col("bytes") > GROUP_BYTES)
    small = texts.where(~many).repartition("gram").sortWithinPartitions(*order)
    small = small.select("gram", "chunk", "content").mapInPandas(
        _matched(length), f"gram long, chunk binary, copied {_SPANS}, later {_SPANS}"
    )
    # Large groups: strings are counted with the first one's place, combined before the shuffle.
    large = texts.where(many)
    strings = large.select("gram", "chunk", "content").mapInPandas(
        _strings(length), "gram long, chunk binary, at int, h1 long, h2 long"
    )
    firsts = large.select("gram", "chunk", "ref")
    strings = saved(strings, "lpf-strings")
    ordered = strings.join(firsts.select("chunk", "gram", F.struct("ref.doc_id", "ref.tid", "ref.first").alias("o")), ["gram", "chunk"])
    counts = ordered.groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("o", "at")).alias("lead")).where("n > 1")
    again = ordered.join(counts, ["h1", "h2"]).select("gram", "chunk", "at", (F.struct("o", "at") != F.col("lead")).alias("is_later"))
    one = lambda c: F.struct(c.alias("s"), (c + 1).alias("e"))
    large = again.groupBy("gram", "chunk").agg(
        F.collect_list(one(F.col("at"))).alias("copied"),
        F.collect_list(F.when(F.col("is_later"), one(F.col("at")))).alias("later"),
    )
    matched = small.unionByName(large.select("gram", "chunk", F.col("copied").cast(_SPANS), F.col("later").cast(_SPANS)))

    # A text that occurs twice is copied as a whole; all but its first place are later copies as a whole.
    none = F.array().cast(_SPANS)
    known = met.join(matched, ["gram", "chunk"], "left").select(
        "gram", "chunk", "n", "ref", F.coalesce("copied", none).alias("copied"), F.coalesce("later", none).alias("later")
    )
    known = known.where((F.col("n") > 1) | (F.size("copied") > 0))
    placed = found.select("doc_id", "tid", "gram", "chunk", "first", "end").join(known, ["gram", "chunk"])
    whole = F.array(F.struct(F.lit(0).alias("s"), (F.col("end") - F.col("first")).alias("e")))
    is_first = F.struct("doc_id", "tid", "first").eqNullSafe(F.struct("ref.doc_id", "ref.tid", "ref.first"))
    moved = lambda c: F.transform(c, lambda x: F.struct((x["s"] + F.col("first")).alias("s"), (x["e"] + F.col("first")).alias("e")))
    placed = placed.select(
        "doc_id",
        "tid",
        moved(F.when(F.col("n") > 1, whole).otherwise(F.col("copied"))).alias("copied"),
        moved(F.when((F.col("n") > 1) & ~is_first, whole).otherwise(F.col("later"))).alias("later"),
    )
    spans = placed.groupBy("doc_id", "tid").agg(
        F.flatten(F.collect_list("copied")).alias("copied"), F.flatten(F.collect_list("later")).alias("later")
    )
    return spans, shared


def covered(spans, length: int) -> list[tuple[int, int]]:
    """Byte runs that the strings at the given runs of starts cover, merged."""
    out: list[list[int]] = []
    for s, e in sorted((x["s"], x["e"] + length - 1) for x in spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def _removed(length: int, column: str, with_text: bool, with_key: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for doc_id, text, spans in zip(batch["doc_id"], batch["text"], batch[column], strict=True):
                raw = (text or "").encode()
                gone = covered(spans, length) if spans is not None else []
                kept, at = [], 0
                for s, e in gone:
                    kept.append(raw[at:s])
                    at = e
                kept.append(raw[at:])
                left = b"".join(kept)
                row = [doc_id, len(raw), len(raw) - len(left), len(gone), hashlib.sha256(left).hexdigest()]
                row += [left.decode("utf-8", "ignore")] * with_text
                rows.append(row + [_text_key(hashlib.md5(raw, usedforsecurity=False).digest())] * with_key)
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"] + ["kept"] * with_text + ["t"] * with_key
            out = pd.DataFrame(rows, columns=names)
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def without_repeats(
    docs: DataFrame, length: int = 400, keep_first: bool = False, with_text: bool = False, shorter: int | None = None
) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256`` (and ``kept``, ``n_shared``) for every row of ``docs(doc_id, text)``.

    Each byte inside a ``length``-byte string that also starts elsewhere goes, or with ``keep_first`` only those of later
    copies. Null texts count as empty and keep nothing; texts shorter than ``length`` stay whole. A cut inside a
    character leaves its bytes out of ``kept`` text, not out of the digest. Repeated rows each get their row; other
    columns are ignored; an empty table gives no rows. With ``shorter`` (a gram to ``length`` bytes), ``n_shared`` tells of passages
    that are too short to go: the bytes in those grams, the least of every string of ``shorter`` bytes, that are among another
    row's too (64-bit hashes). It is over 0 wherever ``shorter`` bytes are shared, and 0 where not even a gram is. Only texts that may have repeats meet their spans in a shuffle.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    column = "later" if keep_first else "copied"
    if shorter is not None and not gram_width(length) <= shorter <= length:
        raise ValueError(f"shorter has to lie between {gram_width(length)} and {length}")
    spans, shared = _repeats(docs, length, shorter)
    spans = saved(spans.select("doc_id", "tid", column), "lpf-spans")
    bits = member_bits(spans, "tid")
    docs = docs.withColumn("tid", F.unhex(F.md5(F.coalesce("text", F.lit("")))))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + ", kept string" * with_text + ", t long" * (shorter is not None)

    plain = only_members(docs, bits, "tid", inside=False).withColumn(column, F.lit(None).cast(_SPANS))
    maybe = only_members(docs, bits, "tid")
    met = maybe.join(spans.withColumnsRenamed({"doc_id": "d", "tid": "t"}), (F.col("tid") == F.col("t")) & F.col("doc_id").eqNullSafe(F.col("d")), "left")
    rows = plain.select("doc_id", "text", column).unionByName(met.select("doc_id", "text", column))
    rows = rows.mapInPandas(_removed(length, column, with_text, shared is not None), schema)
    if shared is None:
        return rows
    return rows.join(shared, "t", "left").select(*[c for c in rows.columns if c != "t"], F.coalesce("n_shared", F.lit(0).cast("long")).alias("n_shared"))
