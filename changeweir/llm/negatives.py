"""Hard-negative mining with an inverted multi-index: cells of two half-space codebooks, visited by certified bounds.

Vectors are cut in halves and each half gets the nearest of its codebook's centroids; the two together name a cell. No row of a
cell scores more with an anchor than the sum of both halves' bounds: the centroid's product, and the half's norm times the
radius of what the centroid holds. Bounds of each half are sorted, and a heap walks the pairs of them
by falling sum (multi-sequence). An anchor's walk ends when no cell left can hold a row that would still count, so results are exact.

Rows are dealt to shards by their id, so that neither a hot vector nor a hot cell meets in one task; a shard indexes
its rows once and the anchors stream past it. Anchors first find their positives, whose scores make the windows, then the
negatives within the windows; each time the shards' firsts are merged by rank.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from changeweir.llm.common import saved, small_batches

#: Rows of a shard: what one task indexes.
SHARD_ROWS = 16_384
#: Centroids of each half, and the rows (those of least hash) and rounds that fit them.
CODES, FIT_ROWS, FIT_ROUNDS = 16, 4096, 8
#: Rows of cells that are scored at once.
CHUNK_ROWS = 1024
#: Inner products below this are exact in double arithmetic.
EXACT = 2.0**53
LONG = np.iinfo(np.int64)


@dataclass(frozen=True)
class Mining:
    """``anchors``: vec_ids divisible by it; ``low`` and ``high`` bound 100 * negative score by the positive's."""

    anchors: int = 100
    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    scale: int = 256


def nearest(half: np.ndarray, codes: np.ndarray) -> np.ndarray:
    return ((codes**2).sum(axis=1) - 2 * half @ codes.T).argmin(axis=1)


def fitted(half: np.ndarray, codes: int = CODES, rounds: int = FIT_ROUNDS) -> np.ndarray:
    """Centroids of a half by k-means from evenly spaced rows; an empty cluster keeps its centroid."""
    if not len(half):
        return np.zeros((1, half.shape[1]))
    centres = half[np.linspace(0, len(half) - 1, min(codes, len(half))).astype(int)].copy()
    for _ in range(rounds):
        code = nearest(half, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, code, half)
        counts = np.bincount(code, minlength=len(centres))
        centres[counts > 0] = sums[counts > 0] / counts[counts > 0, None]
    return centres


class Half:
    """A codebook's centroids with the radii of what a shard's rows put there."""

    def __init__(self, rows: np.ndarray, codes: np.ndarray):
        self.code = nearest(rows, codes)
        self.used = np.unique(self.code)
        self.centres = codes[self.used]
        distance = np.sqrt(((rows - codes[self.code]) ** 2).sum(axis=1))
        radius = np.zeros(len(codes))
        np.maximum.at(radius, self.code, distance)
        self.radii = radius[self.used]
        self.norms = np.sqrt((self.centres**2).sum(axis=1)) + self.radii

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, bounds) by falling bound on the half's score; rounding errors are on the safe side."""
        norm = np.sqrt((q**2).sum())
        bound = self.centres @ q + norm * self.radii
        bound += 1e-9 * norm * self.norms + 1e-3
        bound = np.maximum(np.where(np.isnan(bound), np.inf, bound), float(LONG.min))  # of components whose squares overflow
        order = np.argsort(-bound)
        return self.used[order], bound[order]


class MultiIndex:
    """A shard's rows by cell."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, first: np.ndarray, second: np.ndarray):
        middle = first.shape[1]
        self.halves = Half(rows[:, :middle], first), Half(rows[:, middle:], second)
        cell = self.halves[0].code * len(second) + self.halves[1].code
        order = np.argsort(cell, kind="stable")
        self.ids, self.labels, self.rows = ids[order], labels[order], rows[order]
        self.width = len(second)
        self.begins = np.searchsorted(cell[order], np.arange(len(first) * len(second) + 1))
        self.most = float(np.abs(rows).max(initial=0.0))

    def cells(self, q: np.ndarray) -> Iterator[tuple[float, int, int]]:
        """(bound, begin, end) of the cells that have rows, by falling bound: multi-sequence over both halves' lists."""
        middle = self.halves[0].centres.shape[1]
        (one, u), (two, v) = self.halves[0].bounds(q[:middle]), self.halves[1].bounds(q[middle:])
        heap = [(-(u[0] + v[0]), 0, 0)]
        while heap:
            least, i, j = heapq.heappop(heap)
            if j + 1 < len(v):
                heapq.heappush(heap, (-(u[i] + v[j + 1]), i, j + 1))
            if j == 0 and i + 1 < len(u):
                heapq.heappush(heap, (-(u[i + 1] + v[0]), i + 1, 0))
            cell = one[i] * self.width + two[j]
            if self.begins[cell] < self.begins[cell + 1]:
                yield -least, int(self.begins[cell]), int(self.begins[cell + 1])

    def scores(self, at: np.ndarray, q: np.ndarray) -> np.ndarray:
        """Inner products of the rows ``at`` with ``q``, exactly; beyond a long they are held at its limits."""
        if self.most * np.abs(q).max(initial=0.0) * max(1, len(q)) < EXACT:
            return (self.rows[at] @ q).astype(np.int64)
        whole = [int(x) for x in q]
        exact = [sum(int(x) * y for x, y in zip(row, whole, strict=True)) for row in self.rows[at]]
        return np.array([min(max(x, LONG.min), LONG.max) for x in exact], np.int64)

    def chunks(self, q: np.ndarray) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """(bound on what comes after, rows, their scores), cells by falling bound."""
        held, size, cells = [], 0, self.cells(q)
        for bound, begin, end in cells:
            if size >= CHUNK_ROWS:
                at = np.concatenate(held)
                yield bound, at, self.scores(at, q)
                held, size = [], 0
            held.append(np.arange(begin, end))
            size += end - begin
        if held:
            at = np.concatenate(held)
            yield -np.inf, at, self.scores(at, q)


def firsts(scores: np.ndarray, ids: np.ndarray, most: int) -> np.ndarray:
    """Places of the first ``most`` by falling score, then id."""
    return np.lexsort((ids, ~scores))[:most]  # ~x falls as x rises, for every long


def positives(index: MultiIndex, vec_id: int, label: int, q: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of a shard's first rows of the anchor's label."""
    ids, scores = np.empty(0, np.int64), np.empty(0, np.int64)
    for bound, at, s in index.chunks(q):
        ours = (index.labels[at] == label) & (index.ids[at] != vec_id)
        ids, scores = np.concatenate((ids, index.ids[at][ours])), np.concatenate((scores, s[ours]))
        best = firsts(scores, ids, most)
        ids, scores = ids[best], scores[best]
        if len(ids) == most and bound < scores[-1]:
            break
    return ids, scores


def negatives(index: MultiIndex, vec_id: int, label: int, q: np.ndarray, windows: list[tuple[int, int]], most: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, scores) of a shard's first rows of other labels in each window of scores (both ends included)."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64)) for _ in windows]
    open_ = {k for k, (lo, hi) in enumerate(windows) if lo <= hi}
    for bound, at, s in index.chunks(q) if open_ else ():
        others = (index.labels[at] != label) & (index.ids[at] != vec_id)
        ids, scores = index.ids[at][others], s[others]
        for k in list(open_):
            lo, hi = windows[k]
            fits = (scores >= lo) & (scores <= hi)
            if fits.any():
                i, x = np.concatenate((found[k][0], ids[fits])), np.concatenate((found[k][1], scores[fits]))
                best = firsts(x, i, most)
                found[k] = i[best], x[best]
            if bound < lo or (len(found[k][0]) == most and bound < found[k][1][-1]):
                open_.discard(k)
        if not open_:
            break
    yield from found


_ROWS = "vec_id long, label long, vector binary"


def _quantised(scale: int):
    """Rows that take part, their components as whole doubles. Nulls, of any kind, and non-finite components leave a row out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for vec_id, label, vector in zip(*(batch.column(c).to_pylist() for c in ("vec_id", "label", "vector")), strict=True):
                if vec_id is None or label is None or vector is None or any(x is None for x in vector):
                    continue
                whole = np.floor(scale * np.array(vector, np.float64))
                if np.isfinite(whole).all():
                    kept.append((vec_id, label, whole.tobytes()))
            columns = zip(*kept, strict=True) if kept else ([], [], [])
            types = (pa.int64(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["vec_id", "label", "vector"])

    return run


def _padded(vectors: list[bytes], width: int) -> np.ndarray:
    """Vectors as rows of one width; shorter ones are filled up with zeros."""
    out = np.zeros((len(vectors), width))
    for row, raw in zip(out, vectors, strict=True):
        vector = np.frombuffer(raw, "<f8")
        row[: len(vector)] = vector
    return out


def _searched(width: int, books: tuple[np.ndarray, np.ndarray], mining: Mining, schema: pa.Schema, of_anchor):
    """Rows sorted by shard, a shard's rows before the anchors (which have a number): each anchor against each shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        np.seterr(over="ignore", invalid="ignore")  # bounds are then infinite
        shard = index = None
        ids, labels, vectors, out = [], [], [], []
        for batch in batches:
            for row in batch.to_pylist():
                if row["shard"] != shard:
                    shard, index, ids, labels, vectors = row["shard"], None, [], [], []
                if row["anchor"] is None:
                    ids.append(row["vec_id"])
                    labels.append(row["label"])
                    vectors.append(row["vector"])
                    continue
                if not ids:
                    continue
                if index is None:
                    one = {x: k for k, x in enumerate(zip(ids, labels, vectors, strict=True))}  # equal rows are one
                    at = list(one.values())
                    index = MultiIndex(np.array(ids)[at], np.array(labels)[at], _padded([vectors[k] for k in at], width), *books)
                    vectors = []
                out += of_anchor(index, row, _padded([row["vector"]], width)[0], mining)
                if len(out) >= 10_000:
                    yield pa.RecordBatch.from_pylist(out, schema)
                    out = []
        yield pa.RecordBatch.from_pylist(out, schema)

    return run


def _positives_of(index: MultiIndex, row: dict, q: np.ndarray, mining: Mining) -> list[dict]:
    found = positives(index, row["vec_id"], row["label"], q, mining.positives)
    return [{"anchor": row["anchor"], "id": int(i), "score": int(s)} for i, s in zip(*found, strict=True)]


def window_of(score: int, mining: Mining) -> tuple[int, int]:
    """The least and the greatest negative score of a positive's window; a negative positive score has an empty one."""
    return -(-mining.low * score // 100), mining.high * score // 100


def _negatives_of(index: MultiIndex, row: dict, q: np.ndarray, mining: Mining) -> list[dict]:
    windows = [window_of(p["score"], mining) for p in row["positives"]]
    found = negatives(index, row["vec_id"], row["label"], q, windows, mining.negatives)
    return [
        {"anchor": row["anchor"], "place": p["place"], "id": int(i), "score": int(s)}
        for p, pairs in zip(row["positives"], found, strict=True)
        for i, s in zip(*pairs, strict=True)
    ]


def _ranked(found: DataFrame, keys: list[str], most: int) -> DataFrame:
    """The first ``most`` of each key by score, then id. Tasks cut their own rows to as many before they are dealt out."""
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "id")
    return found.withColumn("place", F.row_number().over(order)).where(F.col("place") <= most)


def hard_negatives(embeddings: DataFrame, mining: Mining = Mining(), shard_rows: int = SHARD_ROWS, codes: int = CODES) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for ``embeddings(vec_id, label, vector)``.

    Codebooks are fitted on the ``FIT_ROWS`` rows of least hash; every row is indexed, and results don't depend on the fit. Every anchor
    meets every shard, so the work grows with the anchors times the shards; anchors are shipped, rows are dealt out once a pass.

    Rows with a null id, label, vector or component, or a non-finite component, take no part. Vectors shorter than the longest are filled up with
    zeros. Rows equal in id, label and vector are one; rows that share only the id are told apart, and none of them is another's
    positive or negative. Scores beyond a long are held at its limits. An anchor without positives, or without rows in the windows,
    gives no row, so an empty table gives none. Other columns are ignored.
    """
    small_batches(embeddings.sparkSession)
    given = embeddings.select(F.col("vec_id").cast("long"), F.col("label").cast("long"), F.col("vector").cast("array<double>"))
    rows = saved(given.mapInArrow(_quantised(mining.scale), _ROWS), "negatives-rows")
    total, width = rows.agg(F.count("*"), F.max(F.octet_length("vector"))).first()
    width, shards = (width or 0) // 8, max(1, -(-total // shard_rows))
    sample = rows.select("vector").orderBy(F.xxhash64("vec_id", "vector")).limit(FIT_ROWS).toArrow()
    fit = _padded(sample["vector"].to_pylist(), width)
    middle = width // 2
    books = fitted(fit[:, :middle], codes), fitted(fit[:, middle:], codes)

    anchors = rows.where(F.col("vec_id") % mining.anchors == 0).dropDuplicates()
    anchors = saved(anchors.withColumn("anchor", F.monotonically_increasing_id()), "negatives-anchors")
    ours = rows.select("*", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).alias("shard"), F.lit(None).cast("long").alias("anchor"))
    everywhere = F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard")

    def meet(theirs: DataFrame, extra: str | None) -> DataFrame:
        """Shards' rows, then every anchor, shard after shard."""
        more = [F.lit(None).cast(theirs.schema[extra].dataType).alias(extra)] if extra else []
        both = ours.select("*", *more).unionByName(theirs.select(*theirs.columns, everywhere))
        return both.repartition("shard").sortWithinPartitions("shard", F.col("anchor").asc_nulls_first())

    found = pa.schema([("anchor", pa.int64()), ("id", pa.int64()), ("score", pa.int64())])
    first = meet(anchors, None).mapInArrow(_searched(width, books, mining, found, _positives_of), "anchor long, id long, score long")
    first = saved(_ranked(first, ["anchor"], mining.positives), "negatives-positives")

    with_positives = anchors.join(
        first.groupBy("anchor").agg(F.collect_list(F.struct("place", "id", "score")).alias("positives")), "anchor"
    )
    found = pa.schema([("anchor", pa.int64()), ("place", pa.int32()), ("id", pa.int64()), ("score", pa.int64())])
    schema = "anchor long, place int, id long, score long"
    second = meet(with_positives, "positives").mapInArrow(_searched(width, books, mining, found, _negatives_of), schema)
    second = second.withColumnRenamed("place", "positive")
    best = _ranked(second, ["anchor", "positive"], mining.negatives)
    best = best.select("anchor", "positive", F.col("place").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    named = first.select("anchor", F.col("place").alias("positive"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    ids = anchors.select("anchor", F.col("vec_id").alias("anchor_id"))
    return best.join(named, ["anchor", "positive"]).join(ids, "anchor").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
