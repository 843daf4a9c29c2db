"""Hierarchical multi-length packing: documents go to tiers of context sizes, each tier is packed, gaps are filled from below.

A tier is a context size; a document goes to the smallest one that holds it, and first gives whole windows of the longest
one where it is longer than that. From the longest tier down, pieces are offered to the gaps that longer windows have
left (best fit) and open windows of their own tier where none fits. What gaps are left then are closed by taking the
emptiest windows apart: their pieces go whole into gaps that hold them, and are cut to close the others. Full windows of
one tier and like attention cost form step groups, so that no rank of a training step waits for another.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.bytelevel import byte_level
from changeweir.llm.common import small_batches

END_ID = 1
#: Context sizes, powers of two: a full window of any of them needs no padding.
TIERS = (2048, 1024, 512, 256)
#: Tokens that are packed together; a task holds one such block and what the one before it has left.
BLOCK_TOKENS = 4_000_000
#: Sequences of a step group.
RANKS = 8


@dataclass
class Piece:
    """``length`` tokens of a document from ``start`` on."""

    doc: int
    start: int
    length: int


@dataclass
class Window:
    size: int
    used: int = 0
    pieces: list[Piece] = field(default_factory=list)

    def put(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.used += piece.length

    @property
    def gap(self) -> int:
        return self.size - self.used

    @property
    def attention(self) -> int:
        return sum(p.length**2 for p in self.pieces)


class BySize:
    """Things with sizes of up to ``most``; the nearest size from above or below is one bit operation away."""

    def __init__(self, most: int):
        self.of: list[list] = [[] for _ in range(most + 1)]
        self.bits = 0

    def put(self, size: int, thing) -> None:
        if size:
            self.of[size].append(thing)
            self.bits |= 1 << size

    def _pop(self, size: int):
        thing = self.of[size].pop()
        if not self.of[size]:
            self.bits ^= 1 << size
        return thing

    def at_least(self, size: int):
        """The smallest thing of at least ``size``; None if there is none."""
        rest = self.bits >> size
        return self._pop(size + (rest & -rest).bit_length() - 1) if rest else None

    def at_most(self, size: int):
        """The largest thing of at most ``size``; None if there is none."""
        rest = self.bits & ((2 << size) - 1)
        return self._pop(rest.bit_length() - 1) if rest else None

    def left(self) -> list:
        return [thing for size in self.of for thing in size]


def route(lengths: list[int], tiers: tuple[int, ...]) -> tuple[list[Window], list[Piece]]:
    """Whole windows of the longest tier, and what goes to be packed."""
    most, whole, rest = tiers[0], [], []
    for doc, n in enumerate(lengths):
        start = 0
        while n - start >= most:
            window = Window(most)
            window.put(Piece(doc, start, most))
            whole.append(window)
            start += most
        if n > start:
            rest.append(Piece(doc, start, n - start))
    return whole, rest


def best_fit(rest: list[Piece], tiers: tuple[int, ...]) -> list[Window]:
    """Windows of all tiers: the longest first, and gaps of longer ones before windows of a piece's own tier."""
    gaps, windows, upward = BySize(tiers[0]), [], tiers[::-1]
    for piece in sorted(rest, key=lambda p: -p.length):
        window = gaps.at_least(piece.length)
        if window is None:
            window = Window(next(t for t in upward if t >= piece.length))
            windows.append(window)
        window.put(piece)
        gaps.put(window.gap, window)
    return windows


def close_gaps(windows: list[Window], most: int) -> tuple[list[Window], list[Piece]]:
    """(full windows, pieces left): the emptiest windows are taken apart until what they hold closes the others' gaps."""
    full = [w for w in windows if not w.gap]
    open_ = sorted((w for w in windows if w.gap), key=lambda w: w.used / w.size)
    need, have, apart = sum(w.gap for w in open_), 0, 0
    while have < need:  # ends: without any open window nothing is needed
        need, have, apart = need - open_[apart].gap, have + open_[apart].used, apart + 1
    pool = BySize(most)
    for window in open_[:apart]:
        for piece in window.pieces:
            pool.put(piece.length, piece)
    for window in sorted(open_[apart:], key=lambda w: -w.gap):
        while gap := window.gap:
            piece = pool.at_most(gap)
            if piece is None:
                long = pool.at_least(gap)
                piece, rest = Piece(long.doc, long.start, gap), Piece(long.doc, long.start + gap, long.length - gap)
                pool.put(rest.length, rest)
            window.put(piece)
        full.append(window)
    return full, pool.left()


def powers(rest: list[Piece], most: int) -> list[Window]:
    """What is left at a task's end in windows of powers of two, each full: one for each binary digit of the tokens left."""
    total, windows = sum(p.length for p in rest), []
    todo = sorted(rest, key=lambda p: p.length)
    while total:
        window = Window(min(most, 1 << (total.bit_length() - 1)))
        while window.gap:
            piece = todo.pop()
            if piece.length > window.gap:
                todo.append(Piece(piece.doc, piece.start + window.gap, piece.length - window.gap))
                piece = Piece(piece.doc, piece.start, window.gap)
            window.put(piece)
        total -= window.size
        windows.append(window)
    return windows


def step_groups(windows: list[Window], ranks: int) -> tuple[list[list[Window]], list[Window]]:
    """Groups of ``ranks`` windows of one size that are next to each other by attention cost; what is left over."""
    groups, left = [], []
    for size in sorted({w.size for w in windows}, reverse=True):
        alike = sorted((w for w in windows if w.size == size), key=lambda w: -w.attention)
        whole = len(alike) // ranks * ranks
        groups += [alike[at : at + ranks] for at in range(0, whole, ranks)]
        left += alike[whole:]
    return groups, left


SCHEMA = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, tier int, step_group long"
)


class Packer:
    """Packs a task's documents block by block. ``first`` is the number of the task's first sequence and group."""

    def __init__(self, first: int, tiers: tuple[int, ...], block_tokens: int, ranks: int):
        self.tiers, self.block_tokens, self.ranks = tiers, block_tokens, ranks
        self.docs: list[tuple[int | None, np.ndarray]] = []
        self.pieces: list[Piece] = []  # left by the block before, as pieces of self.docs
        self.fresh: list[int] = []
        self.tokens = 0
        self.waiting: list[Window] = []
        self.rows_of: dict[int, list[tuple]] = {}  # rows of windows that wait for their group, without numbers
        self.sequence = self.group = first

    def add(self, doc_id: int | None, ids: np.ndarray) -> Iterator[list[tuple]]:
        self.fresh.append(len(self.docs))
        self.docs.append((doc_id, ids))
        self.tokens += len(ids)
        if self.tokens >= self.block_tokens:
            yield self._block(last=False)

    def end(self) -> list[tuple]:
        return self._block(last=True)

    def _block(self, last: bool) -> list[tuple]:
        most = self.tiers[0]
        whole, rest = route([len(self.docs[i][1]) for i in self.fresh], self.tiers)
        for piece in [p for w in whole for p in w.pieces] + rest:
            piece.doc = self.fresh[piece.doc]
        full, left = close_gaps(best_fit(rest + self.pieces, self.tiers), most)
        full += whole
        if last:
            full, left = full + powers(left, most), []
        for window in full:
            self.rows_of[id(window)] = self._rows(window)
        groups, self.waiting = step_groups(self.waiting + full, self.ranks)
        if last:
            sizes = sorted({w.size for w in self.waiting}, reverse=True)
            groups += [[w for w in self.waiting if w.size == size] for size in sizes]
            self.waiting = []
        rows = [row for group in groups for row in self._numbered(group)]
        # Only documents that still have pieces to place are held on.
        held = {doc: i for i, doc in enumerate(dict.fromkeys(p.doc for p in left))}
        self.docs = [self.docs[doc] for doc in held]
        self.pieces = [Piece(held[p.doc], p.start, p.length) for p in left]
        self.fresh, self.tokens = [], 0
        return rows

    def _rows(self, window: Window) -> list[tuple]:
        rows, offset = [], 0
        for p in window.pieces:
            doc_id, ids = self.docs[p.doc]
            rows.append((doc_id, p.start, p.length, zlib.crc32(ids[p.start : p.start + p.length]), len(ids), offset, window.size))
            offset += p.length
        return rows

    def _numbered(self, group: list[Window]) -> Iterator[tuple]:
        for window in group:
            for *row, offset, size in self.rows_of.pop(id(window)):
                yield (*row, self.sequence, offset, size, self.group)
            self.sequence += 1
        self.group += 1


def pack_documents(
    docs: DataFrame, tokenizer_path: str, tiers: tuple[int, ...] = TIERS, block_tokens: int = BLOCK_TOKENS, ranks: int = RANKS
) -> DataFrame:
    """A row for every piece of ``docs(doc_id, text)``: the contract's columns, its window's ``tier``, its ``step_group``.

    Each task packs the rows it reads, so nothing is shuffled and no document is read twice; every sequence is full, as what a
    task has left at its end goes into windows of powers of two. Sequences and groups are numbered from the task's number times
    2^32 on; a lost task packs the same rows to the same numbers again. A group has ``ranks`` sequences of one size, but for
    the last of each size in a task.

    Null and empty texts are the end id alone. Rows that repeat are packed each, null doc_ids too. An empty table gives no
    rows. Other columns are ignored. ``tiers`` are powers of two, falling.
    """
    if any(t & (t - 1) or t < 1 for t in tiers) or list(tiers) != sorted(set(tiers), reverse=True):
        raise ValueError("tiers are falling powers of two")
    small_batches(docs.sparkSession)
    names = [f.split()[0] for f in SCHEMA.split(", ")]
    types = [pa.int32() if f.split()[1] == "int" else pa.int64() for f in SCHEMA.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, end = byte_level(tokenizer_path), np.array([END_ID], "<u4")
        packer = Packer(TaskContext.get().partitionId() << 32, tiers, block_tokens, ranks)

        def batch_of(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [[] for _ in names]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)

        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = np.concatenate((vocabulary.ids(text.as_py() or ""), end)).astype("<u4", copy=False)
                for rows in packer.add(doc_id, ids):
                    yield batch_of(rows)
        yield batch_of(packer.end())

    ids = F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")
    return docs.select(*ids).mapInArrow(run, SCHEMA)
