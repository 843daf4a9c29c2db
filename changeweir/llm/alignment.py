"""Cross-tokenizer alignment with corpus-wide pair counts by external spill counting.

Two vocabularies cut the same bytes. Where both end a token a group ends; an occurrence of an A token and one of a B token
are linked where their bytes overlap. How often an id pair is linked in the whole corpus is counted outside of memory:

* Tasks align blocks of documents and write, for each radix of the B id, one sorted run compressed by zstd: the block's
  distinct pairs in B-major order, and below each pair the documents that hold it (``_spilled``).
* Runs of a radix are merged by a k-way heap, at most ``FAN_IN`` at a time, until one is left (``merged``). Equal pairs
  fold into one entry at every level, so no pair, however common, is more than one entry of a run.
* The last merge goes through a B id's pairs in a row, so their maximum is known when the next B id comes (``maxima``).
* Counts stream past the blocks' runs in the same order; each run gives back one vector of its documents' shares (``_returned``), and a
  block's vectors are added up (``_finished``).
"""

from __future__ import annotations

import hashlib
import heapq
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.bytelevel import byte_level, pieces
from changeweir.llm.common import saved, small_batches

#: Runs of a block: one for each value of the low bits of the B id.
RADIX_BITS = 6
#: Bytes of text of a block; a longer text is a block of its own.
BLOCK_BYTES = 4 * 1024 * 1024
#: Documents of a block (their places take 16 bits of a record).
BLOCK_DOCS = 1 << 15
#: Runs that one merge reads.
FAN_IN = 128
#: Blocks whose runs of a radix one task gives counts back to.
RETURN_BLOCKS = 512
#: Pairs of one compressed frame of a run.
FRAME = 1 << 14
#: A record is B id, A id and document in one 64-bit number.
ID_BITS, DOC_BITS = 21, 16


def planes(*columns: np.ndarray) -> bytes:
    """Columns of unsigned 64-bit numbers as zstd, lowest bytes first; high bytes are mostly zeros and vanish."""
    raw = b"".join(np.ascontiguousarray(c.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes() for c in columns)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unplaned(raw: bytes, columns: int) -> list[np.ndarray]:
    flat = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(columns, 8, -1)
    return [np.ascontiguousarray(c.T).view("<u8").ravel() for c in flat]


def framed(keys: np.ndarray, *columns: np.ndarray) -> bytes:
    """A run: frames of at most ``FRAME`` entries, each behind its length. Keys rise and are kept as differences."""
    out = []
    for at in range(0, len(keys), FRAME):
        part = keys[at : at + FRAME]
        frame = planes(np.diff(part, prepend=np.uint64(0)), *(c[at : at + FRAME] for c in columns))
        out += [len(frame).to_bytes(4, "little"), frame]
    return b"".join(out)


def frames(run: bytes, columns: int) -> Iterator[list[np.ndarray]]:
    """A run's frames one after another: keys, then the other columns."""
    at = 0
    while at < len(run):
        size = int.from_bytes(run[at : at + 4], "little")
        keys, *rest = unplaned(run[at + 4 : at + 4 + size], columns)
        yield [np.cumsum(keys, dtype=np.uint64), *rest]
        at += 4 + size


def folded(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sums of their counts."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(counts, first)


def merged(runs: list[Iterator[list[np.ndarray]]]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs of (keys, counts) frames as one run of distinct keys, by a heap over the frames at hand.

    The frame whose last key is least bounds what can be given out: every run has shown its entries up to there. Only
    that frame's run reads on, so each run holds one frame, whatever the runs' lengths.
    """
    heap, open_ = [], {}
    for k, run in enumerate(runs):
        if (frame := next(run, None)) is not None:
            open_[k] = frame
            heap.append((int(frame[0][-1]), k))
    heapq.heapify(heap)
    while heap:
        bound, _ = heap[0]
        keys, counts = [], []
        for k, (x, c) in list(open_.items()):
            n = int(np.searchsorted(x, np.uint64(bound), "right"))
            if n:
                keys.append(x[:n])
                counts.append(c[:n])
                open_[k] = [x[n:], c[n:]]
        yield folded(np.concatenate(keys), np.concatenate(counts))
        while heap and heap[0][0] == bound:
            _, k = heapq.heappop(heap)
            if (frame := next(runs[k], None)) is None:
                del open_[k]
            else:
                open_[k] = frame
                heapq.heappush(heap, (int(frame[0][-1]), k))


def maxima(entries: Iterator[tuple[np.ndarray, np.ndarray]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(keys, counts, best): whether a pair's count is the highest of its B id. A B id is given out when it is over."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.uint64)

    def marked(keys: np.ndarray, counts: np.ndarray):
        side = keys >> np.uint64(ID_BITS)
        first = np.flatnonzero(np.concatenate(([True], side[1:] != side[:-1])))
        highest = np.maximum.reduceat(counts, first)
        return keys, counts, counts == np.repeat(highest, np.diff(np.append(first, len(keys))))

    for x, c in entries:
        keys, counts = np.concatenate((keys, x)), np.concatenate((counts, c))
        whole = int(np.searchsorted(keys, keys[-1] >> np.uint64(ID_BITS) << np.uint64(ID_BITS)))
        if whole:
            yield marked(keys[:whole], counts[:whole])
            keys, counts = keys[whole:], counts[whole:]
    if len(keys):
        yield marked(keys, counts)


class Aligner:
    """Aligns texts by two vocabularies."""

    def __init__(self, path_a: str, path_b: str):
        self.a, self.b = byte_level(path_a), pieces(path_b)
        if max(len(self.a.bytes_of), len(self.b.bytes_of)) > 1 << ID_BITS:
            raise ValueError(f"vocabularies of more than {1 << ID_BITS} ids")
        self.sizes_a, self.sizes_b = (np.array([len(x) for x in v.bytes_of], np.int64) for v in (self.a, self.b))
        names = lambda v, ends: [f"{i}{end}".encode() for i in range(len(v.bytes_of)) for end in ends]
        self.names = names(self.a, ",|") + names(self.b, ",;")

    def align(self, text: str | None) -> tuple[int, int, int, str, np.ndarray, np.ndarray]:
        """(A tokens, B tokens, groups, digest of the groups, A id of each link, B id of each link)."""
        none = np.empty(0, np.int64)
        if not text:
            return 0, 0, 0, "", none, none
        raw = b" " + text.encode()
        ids_a, ids_b = self.a.plain_ids(" " + text).astype(np.int64), self.b.plain_ids(text).astype(np.int64)
        for vocabulary, ids in ((self.a, ids_a), (self.b, ids_b)):
            if b"".join(map(vocabulary.bytes_of.__getitem__, ids.tolist())) != raw:
                return 0, 0, 0, "", none, none
        ends_a, ends_b = np.cumsum(self.sizes_a[ids_a]), np.cumsum(self.sizes_b[ids_b])
        # Each end of either side closes one link: that of the tokens that hold the byte before it.
        at_b = np.searchsorted(ends_b, ends_a)
        is_common = ends_b[at_b] == ends_a
        common = ends_a[is_common]
        ends = np.sort(np.concatenate((ends_a[~is_common], ends_b)))
        link_a, link_b = ids_a[np.searchsorted(ends_a, ends)], ids_b[np.searchsorted(ends_b, ends)]
        # Groups in order, A's tokens before B's; a group's last token of a side has the other sign behind it.
        group_a, group_b = np.searchsorted(common, ends_a), np.searchsorted(common, ends_b)
        codes = np.empty(len(ids_a) + len(ids_b), np.int64)
        last_b = common[np.minimum(group_b, len(common) - 1)] == ends_b
        codes[np.arange(len(ids_a)) + np.searchsorted(group_b, group_a)] = 2 * ids_a + is_common
        codes[np.arange(len(ids_b)) + np.searchsorted(group_a, group_b, "right")] = 2 * (len(self.sizes_a) + ids_b) + last_b
        spelled = b"".join(map(self.names.__getitem__, codes.tolist()))[:-1]
        return len(ids_a), len(ids_b), len(common), hashlib.sha256(spelled).hexdigest(), link_a, link_b


_NUMBERS = ("n_a", "n_b", "n_groups", "n_links")
_META = "doc_id array<long>, " + ", ".join(f"{c} array<long>" for c in _NUMBERS) + ", groups_sha256 array<string>"
_SPILLED = f"block long, radix int, pairs binary, docs binary, {_META}"
_SPILLED_TYPES = pa.schema([
    ("block", pa.int64()), ("radix", pa.int32()), ("pairs", pa.binary()), ("docs", pa.binary()), ("doc_id", pa.list_(pa.int64())),
    *((c, pa.list_(pa.int64())) for c in _NUMBERS), ("groups_sha256", pa.list_(pa.string())),
])


def turned(ids: np.ndarray, bits: int) -> np.ndarray:
    """B ids with their low ``bits`` put first: in this order, ids of one radix stand together, and each id's pairs too."""
    ids = ids.astype(np.uint64)
    return (ids & np.uint64((1 << bits) - 1)) << np.uint64(ID_BITS - bits) | ids >> np.uint64(bits)


def runs_of(link_a: np.ndarray, link_b: np.ndarray, doc: np.ndarray, bits: int) -> Iterator[tuple[int, bytes, bytes]]:
    """(radix, pairs, documents of the pairs) for each radix that a block's links have."""
    records = turned(link_b, bits) << np.uint64(ID_BITS + DOC_BITS) | link_a.astype(np.uint64) << np.uint64(DOC_BITS) | doc.astype(np.uint64)
    records.sort()
    first = np.flatnonzero(np.concatenate(([True], records[1:] != records[:-1])))
    times = np.diff(np.append(first, len(records)))
    records = records[first]  # one a pair and document
    keys = records >> np.uint64(DOC_BITS)
    begin = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    pairs = keys[begin]
    totals = np.add.reduceat(times, begin)
    holders = np.diff(np.append(begin, len(keys)))
    radix = (pairs >> np.uint64(2 * ID_BITS - bits)).astype(np.int64)
    cuts = np.flatnonzero(np.concatenate(([True], radix[1:] != radix[:-1])))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(pairs)), strict=True):
        at, to = begin[lo], begin[hi] if hi < len(pairs) else len(records)
        places = records[at:to] & np.uint64((1 << DOC_BITS) - 1)
        documents = planes(np.concatenate((np.array([hi - lo, to - at]), holders[lo:hi], places, times[at:to])))
        yield int(radix[lo]), framed(pairs[lo:hi], totals[lo:hi]), documents


def _spilled(path_a: str, path_b: str, bits: int, block_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, block = Aligner(path_a, path_b), TaskContext.get().partitionId() << 32
        rows: list[tuple] = []
        links: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flushed() -> Iterator[pa.RecordBatch]:
            found: list[dict] = [dict(zip(("doc_id", *_NUMBERS, "groups_sha256"), map(list, zip(*rows, strict=True)), strict=True)) | {"block": block, "radix": -1}]
            doc = np.repeat(np.arange(len(links)), [len(a) for a, _ in links])
            if len(doc):
                link_a, link_b = (np.concatenate(x) for x in zip(*links, strict=True))
                for radix, pairs, documents in runs_of(link_a, link_b, doc, bits):
                    found.append({"block": block, "radix": radix, "pairs": pairs, "docs": documents})
            yield pa.RecordBatch.from_pylist(found, _SPILLED_TYPES)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = text.as_py()
                new = len((text or "").encode())
                if rows and (size + new > block_bytes or len(rows) == BLOCK_DOCS):
                    yield from flushed()
                    rows, links, size, block = [], [], 0, block + 1
                n_a, n_b, n_groups, digest, link_a, link_b = aligner.align(text)
                rows.append((doc_id, n_a, n_b, n_groups, len(link_a), digest))
                links.append((link_a.astype(np.int32), link_b.astype(np.int32)))
                size += new
        if rows:
            yield from flushed()

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...]) -> Iterator[tuple[tuple, Iterator[dict]]]:
    """Rows of one key after another; rows come sorted by their keys."""
    rows = (dict(zip(b.schema.names, r, strict=True)) for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
    return itertools.groupby(rows, key=lambda r: tuple(r[k] for k in keys))


def _gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One run for each (radix, group)."""
    for (radix, group), rows in _groups(batches, ("radix", "part")):
        parts = list(merged([frames(r["pairs"], 2) for r in rows]))
        run = framed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_pydict({"radix": pa.array([radix], pa.int32()), "part": pa.array([group], pa.int64()), "pairs": [run]})


def _marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each radix's last run with the mark of a B id's highest counts."""
    for (radix,), rows in _groups(batches, ("radix",)):
        parts = list(maxima(merged([frames(r["pairs"], 2) for r in rows])))
        run = framed(*(np.concatenate(c) for c in zip(*parts, strict=True)))
        yield pa.RecordBatch.from_pydict({"radix": pa.array([radix], pa.int32()), "pairs": [run]})


def _returned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's share of a radix: per document, links at their B id's highest count, and the sum of counts."""
    for _, rows in _groups(batches, ("radix", "part")):
        keys = counts = best = np.empty(0, np.uint64)
        blocks, vectors = [], []
        for row in rows:
            if row["block"] is None:  # comes first
                keys, counts, best = (np.concatenate(c) for c in zip(*frames(row["pairs"], 3), strict=True))
                continue
            pairs = np.concatenate([f[0] for f in frames(row["pairs"], 2)])
            at = np.searchsorted(keys, pairs)
            (flat,) = unplaned(row["docs"], 1)
            n_pairs, n_records = int(flat[0]), int(flat[1])
            holders, places, times = np.split(flat[2:].astype(np.int64), [n_pairs, n_pairs + n_records])
            at = np.repeat(at, holders)
            shares = np.zeros((2, int(places.max()) + 1), np.int64)
            np.add.at(shares[0], places, times * best[at].astype(np.int64))
            np.add.at(shares[1], places, times * counts[at].astype(np.int64))
            blocks.append(row["block"])
            vectors.append(planes(*shares))
            if len(blocks) == 64:
                yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "shares": vectors})
                blocks, vectors = [], []
        if blocks:
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "shares": vectors})


_RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"


def _finished(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A block's documents with the sums of its shares."""
    for _, rows in _groups(batches, ("block",)):
        total, meta = None, None
        for row in rows:
            if row["shares"] is None:  # comes first
                meta, total = row, np.zeros((2, len(row["doc_id"])), np.int64)
                continue
            for side, share in enumerate(unplaned(row["shares"], 2)):
                total[side, : len(share)] += share.astype(np.int64)
        columns = {c: meta[c] for c in ("doc_id", *_NUMBERS)} | {"n_best": total[0], "count_sum": total[1], "groups_sha256": meta["groups_sha256"]}
        yield pa.RecordBatch.from_arrays([pa.array(v, pa.string() if c == "groups_sha256" else pa.int64()) for c, v in columns.items()], list(columns))


def _by(df: DataFrame, keys: list[str], *then) -> DataFrame:
    """Rows of one key next to each other in one task."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *then)


def align(docs: DataFrame, path_a: str, path_b: str, bits: int = RADIX_BITS, block_bytes: int = BLOCK_BYTES, fan_in: int = FAN_IN) -> DataFrame:
    """The contract's row for every row of ``docs(doc_id, text)``.

    A is a byte-level vocabulary (read with a blank before the text), B a sentence-piece one (which puts it there). Runs
    are written to the shared scratch folder once, and each merge reads at most ``fan_in`` runs of one radix, so memory is bounded
    by a frame of each; what a task holds besides is one block, or the distinct pairs of one radix, which the vocabularies bound.

    Null and empty texts, and texts that a vocabulary doesn't give back byte for byte, have no tokens: zeros and ''.
    Rows that repeat count and are returned each, null doc_ids too. Other columns are ignored. An empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    ids = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    spilled = saved(docs.select(*ids).mapInArrow(_spilled(path_a, path_b, bits, block_bytes), _SPILLED), "alignment-runs")
    meta, runs = spilled.where("radix < 0"), spilled.where("radix >= 0").select("block", "radix", "pairs", "docs")

    blocks = meta.count()
    part = lambda n: F.pmod(F.xxhash64("block"), F.lit(max(1, n)))
    parts = -(-blocks // fan_in)
    state = runs.select("radix", part(parts).alias("part"), "pairs")
    while parts > 1:
        state = saved(_by(state, ["radix", "part"]).mapInArrow(_gathered, "radix int, part long, pairs binary"), "alignment-merged")
        parts = -(-parts // fan_in)
        state = state.withColumn("part", F.pmod("part", F.lit(parts)))
    counts = saved(_by(state, ["radix"]).mapInArrow(_marked, "radix int, pairs binary"), "alignment-counts")

    # One copy of a radix's counts for every task's share of the blocks.
    copies = -(-blocks // RETURN_BLOCKS)
    ours = runs.select("radix", part(copies).alias("part"), "block", "pairs", "docs")
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(max(0, copies - 1)).cast("long"))).alias("part")
    theirs = counts.select("radix", each, F.lit(None).cast("long").alias("block"), "pairs", F.lit(None).cast("binary").alias("docs"))
    both = _by(theirs.union(ours), ["radix", "part"], F.col("block").asc_nulls_first())
    shares = both.mapInArrow(_returned, "block long, shares binary")

    lists = ["doc_id", *_NUMBERS, "groups_sha256"]
    heads = meta.select("block", F.lit(None).cast("binary").alias("shares"), *lists, F.lit(0).alias("turn"))
    shares = shares.select("block", "shares", *[F.lit(None).cast(meta.schema[c].dataType).alias(c) for c in lists], F.lit(1).alias("turn"))
    return _by(heads.union(shares), ["block"], "turn").drop("turn").mapInArrow(_finished, _RESULT)
