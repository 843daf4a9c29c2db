"""MinHash near-duplicates by SetSketch registers: band, estimate by likelihood, verify on full sets.

A register holds an exponentially spaced, truncated minimum: with h the least of a document's
exponential hash values, K = floor(1 - log_b(h)), kept within 0..q+1. Registers of a union are
the maxima of the parts' registers (``merge``), and two documents agree in a register with a probability close to
their Jaccard similarity. Documents that agree in all registers of a band meet; the joint
likelihood of "larger, smaller, equal" counts over all registers estimates their similarity and drops hopeless pairs;
the rest is confirmed on whole sets. With 32 bands of 4 registers a pair at 0.8 is missed once in 2e7 (at 0.85, once in 1e10).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from changeweir.llm.common import (
    Minima,
    Words,
    lower_words,
    maybe_member,
    member_bits,
    member_place,
    mixed,
    only_members,
    saved,
    shingles,
    signed,
    small_batches,
)
from changeweir.llm.graph import components, linked_in_buckets

REGISTERS, ROWS = 128, 4
BASE, RATE, LIMIT = 1.001, 20.0, 2**16 - 2
#: Pairs estimated this far below the threshold are not verified: seven standard errors.
MARGIN = 0.25


class Sketcher:
    """Registers of a set of 64-bit hashes."""

    def __init__(self):
        self.minima = Minima(REGISTERS)

    def of(self, values: np.ndarray) -> np.ndarray:
        least = (self.minima.of(values).astype(np.float64) + 1.0) / 2.0**64
        exponential = -np.log1p(-np.minimum(least, 1 - 1e-16)) / RATE
        return np.clip(np.floor(1 - np.log(exponential) / np.log(BASE)), 0, LIMIT + 1).astype(np.uint16)


def merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Registers of the union of two sets."""
    return np.maximum(a, b)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """(documents, bands): one 64-bit key for each band's registers."""
    n, m = registers.shape
    packed = np.ascontiguousarray(registers).view(np.uint64).reshape(n, m // ROWS)
    return mixed(packed ^ mixed(np.arange(1, m // ROWS + 1, dtype=np.uint64)))


def likeliest(larger, smaller, equal, n_a, n_b) -> np.ndarray:
    """Maximum-likelihood Jaccard similarity, jointly from both sketches' register comparisons and the set sizes."""
    grid = np.linspace(0.005, 1.0, 200)
    u = (n_a / (n_a + n_b))[:, None]
    v = 1 - u

    def p(x):
        x = np.clip(x, 0, 1)
        return -np.log1p(-x * (BASE - 1) / BASE) / np.log(BASE)

    up, down = p(u - v * grid), p(v - u * grid)
    tiny = 1e-12
    score = (
        larger[:, None] * np.log(np.maximum(up, tiny))
        + smaller[:, None] * np.log(np.maximum(down, tiny))
        + equal[:, None] * np.log(np.maximum(1 - up - down, tiny))
    )
    score[grid[None, :] > np.minimum(u / v, v / u) + 1e-9] = -np.inf
    return grid[score.argmax(axis=1)]


def _sketched(k: int):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache, sketcher = Words(), Sketcher()
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                values = shingles(lower_words(text), k, cache)
                if len(values):
                    digest = xxhash.xxh3_128_digest(values.tobytes())
                    rows.append((doc_id, len(values), digest, sketcher.of(values).tobytes()))
                else:
                    rows.append((doc_id, 0, None, None))
            out = pd.DataFrame(rows, columns=["doc_id", "n_shingles", "digest", "registers"])
            out["doc_id"] = out["doc_id"].astype("Int64")
            yield out

    return run


def _banded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        if len(batch):
            registers = np.frombuffer(b"".join(batch["registers"]), np.uint16).reshape(len(batch), -1)
            keys = signed(band_keys(registers))
            yield pd.DataFrame({"key": keys.ravel(), "cid": np.repeat(batch["cid"].to_numpy(), keys.shape[1])})


def _promising(threshold: float):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            a = np.frombuffer(b"".join(batch["ra"]), np.uint16).reshape(len(batch), -1)
            b = np.frombuffer(b"".join(batch["rb"]), np.uint16).reshape(len(batch), -1)
            larger, smaller = (a > b).sum(axis=1), (a < b).sum(axis=1)
            equal = a.shape[1] - larger - smaller
            est = likeliest(larger, smaller, equal, batch["na"].to_numpy(float), batch["nb"].to_numpy(float))
            yield batch.loc[est >= threshold - MARGIN, ["a", "b"]]

    return run


def _sets(k: int, bits: bytes):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        cache = Words()
        for batch in batches:
            rows = []
            for text in batch.loc[maybe_member(bits, batch["place"].to_numpy()), "text"]:
                values = shingles(lower_words(text), k, cache)
                if len(values):
                    rows.append((xxhash.xxh3_128_digest(values.tobytes()), signed(values)))
            yield pd.DataFrame(rows, columns=["digest", "shingles"])

    return run


def _full_sets(cids: DataFrame, reps: DataFrame, docs: DataFrame, k: int) -> DataFrame:
    """``cid, shingles`` of the given classes, from whole texts. One row of each class was noted; a text that has its
    doc_id is looked up by the set's digest again."""
    wanted = saved(reps.join(cids, "cid").select("cid", "digest", "doc"), "setsketch-wanted")
    texts = docs.select("text", member_place("doc_id").alias("place"))
    found = texts.mapInPandas(_sets(k, member_bits(wanted, "doc")), "digest binary, shingles array<long>")
    found = found.join(wanted.select("cid", "digest"), "digest").drop("digest").dropDuplicates(["cid"])
    return saved(found, "setsketch-sets")


def _verified(pairs: DataFrame, reps: DataFrame, docs: DataFrame, k: int, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sets reach the threshold: sketches first, then whole sets."""
    pairs = saved(pairs, "setsketch-pairs")
    side = lambda x: reps.select(F.col("cid").alias(x), F.col("n").alias(f"n{x}"), F.col("registers").alias(f"r{x}"))
    fits = F.least("na", "nb") * 100 >= F.greatest("na", "nb") * percent
    near = pairs.join(side("a"), "a").join(side("b"), "b").where(fits)
    near = saved(near.mapInPandas(_promising(percent / 100), "a long, b long"), "setsketch-near")
    found = _full_sets(near.select(F.col("b").alias("cid")).union(near.select("a")).distinct(), reps, docs, k)
    with_b = near.join(found.withColumnsRenamed({"cid": "b", "shingles": "sb"}), "b")
    with_ab = with_b.join(found.withColumnsRenamed({"cid": "a", "shingles": "sa"}), "a")
    # Sorted distinct hashes: the built-in intersection is one hash set a pair.
    common = F.size(F.array_intersect("sa", "sb")).cast("long")
    counted = with_ab.select("a", "b", common.alias("common"), (F.size("sa") + F.size("sb")).alias("sizes"))
    linked = counted.where(F.col("common") * 100 >= F.lit(percent) * (F.col("sizes") - F.col("common")))
    return saved(linked.select("a", "b"), "setsketch-links")


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    Two documents are linked when 100 * |intersection| >= percent * |union| of their distinct k-word
    shingle sets; ``component_id`` is the smallest doc_id reachable.

    * Equal sets are one class before anything is compared, so exact copies never pair up.
    * Buckets are joined by hubs (``linked_in_buckets``), then by an exact filter across components, so a
      group of near copies costs stars, not all its pairs, and no pair is cut off.
    * Whole sets are read for candidates only.

    Null and empty texts, and texts of white space, have no shingles and are linked with nothing. A null doc_id
    is never a component's id unless the component has no other; ``kept`` compares null-safely.
    Repeated rows, also of one doc_id with several texts, each get their row; rows of one doc_id are one node.
    Other columns are ignored; an empty table gives an empty result.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_shingles long, digest binary, registers binary"
    rows = saved(docs.mapInPandas(_sketched(k), schema), "setsketch-rows")
    classes = rows.where("digest is not null").groupBy("digest").agg(
        F.min("doc_id").alias("doc"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers")
    )
    reps = saved(classes.withColumn("cid", F.monotonically_increasing_id()), "setsketch-classes")

    keys = reps.select("cid", "registers").mapInPandas(_banded, "key long, cid long")
    links = linked_in_buckets(
        keys,
        lambda pairs: _verified(pairs, reps, docs, k, percent),
        lambda cids: _full_sets(cids, reps, docs, k),
        percent,
    )

    # Rows of one doc_id are one node: its classes are tied by edges of their own.
    classed = rows.where("digest is not null and doc_id is not null").select("doc_id", "digest").distinct()
    several = classed.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    tied = classed.join(several, "doc_id").join(reps.select("digest", "cid"), "digest")
    tied = tied.join(tied.groupBy("doc_id").agg(F.min("cid").alias("a")), "doc_id").select("a", F.col("cid").alias("b"))
    roots = components(links.union(tied))
    labelled = reps.join(roots.withColumnRenamed("node", "cid"), "cid", "left").select(
        "digest", "doc", F.coalesce("root", "cid").alias("root")
    )
    smallest = labelled.groupBy("root").agg(F.min("doc").alias("component"))
    labelled = labelled.join(smallest, "root").select("digest", "component")
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component"))
    return rows.join(labelled, "digest", "left").select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"),
    )


def without_near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs``, all columns, of which one stays for each group: that of the smallest doc_id.

    Rows of the same doc_id and text are one document; any one of them stays.
    """
    verdicts = saved(near_duplicates(docs, k, percent), "setsketch-verdicts")
    by_id = verdicts.groupBy("doc_id").agg(F.count("*").alias("n"), F.max("kept").alias("kept"))
    touched = saved(by_id.where("n > 1 or not kept"), "setsketch-touched")
    # Most rows are alone and stay; only those that a filter of fixed size lets through meet the list.
    bits, docs_ = member_bits(touched, "doc_id"), docs.withColumn("_cw_id", F.col("doc_id").cast("long"))
    plain = only_members(docs_, bits, "_cw_id", inside=False).drop("_cw_id")
    gone = touched.where("not kept").select(F.col("doc_id").alias("_cw_gone"))
    met = only_members(docs_, bits, "_cw_id").join(gone, F.col("_cw_id").eqNullSafe(F.col("_cw_gone")), "left_anti")
    return plain.union(met.dropDuplicates(["doc_id", "text"]).drop("_cw_id"))
