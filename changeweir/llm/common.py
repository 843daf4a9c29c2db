"""What the operators of this subpackage share: written intermediates, word hashes, membership bits."""

from __future__ import annotations

import numpy as np
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from changeweir.session import scratch_folder

#: Words kept by a worker's cache before it starts afresh (a bound on memory only).
CACHED_WORDS = 300_000
#: Bits of a membership filter: 128 KB, whatever the number of keys.
MEMBER_BITS = 1 << 20
#: Most positions of a filter that is sized by the number of its keys.
MOST_BITS = 1 << 27
#: Each byte with its bits in the other order.
_TURNED = np.packbits(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little"), axis=1).ravel()
#: Rows and bytes of a batch that Python workers get: what a task holds beside its own state.
BATCH_ROWS, BATCH_BYTES = 1000, 4 * 1024 * 1024


def small_batches(spark: SparkSession) -> None:
    """Whole texts go to Python in batches of a few MB, so long texts don't fill a worker a thousand at a time."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def saved(df: DataFrame, label: str) -> DataFrame:
    """``df`` written to the shared scratch folder and read again: lineage ends there, sizes are known."""
    path = scratch_folder(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Words(dict):
    """Hash of a word; computed once for each word that a worker meets."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def lower_words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8, A-Z lower-cased. bytes.lower and bytes.split do just that."""
    return text.encode().lower().split() if text else []


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(words: list[bytes], k: int, cache: Words) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the k-word shingles; fewer words are one shingle, none give an empty set."""
    n = len(words)
    if not n:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(cache.__getitem__, words), np.uint64, n)
    width = min(k, n)
    out = np.full(n - width + 1, width, np.uint64)
    for j in range(width):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : n - width + 1 + j])
    out.sort()
    return out[np.concatenate(([True], out[1:] != out[:-1]))]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


class Minima:
    """Minima of ``m`` independent hash functions over a set of 64-bit hashes."""

    def __init__(self, m: int):
        salts = mixed(np.arange(1, 2 * m + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        self.factors, self.offsets = salts[:m] | np.uint64(1), salts[m:]

    def of(self, values: np.ndarray) -> np.ndarray:
        """One value a function; a block of values at a time, so that memory stays bounded."""
        least = None
        for at in range(0, len(values), 512):
            block = (values[at : at + 512, None] * self.factors + self.offsets).min(axis=0)
            least = block if least is None else np.minimum(least, block)
        return least

    def of_each(self, values: np.ndarray, begins: np.ndarray) -> np.ndarray:
        """(lists, functions): minima of each stretch of values."""
        return np.minimum.reduceat(values[:, None] * self.factors + self.offsets, begins, axis=0)


def member_bits(keys: DataFrame, column: str, places_of: int | None = None) -> bytes:
    """A filter over a column's values: ``MEMBER_BITS`` positions, an eighth as many bytes, reach the driver.

    With ``places_of`` (a power of two from 2^15 on), the column holds positions below that number already.

    A value that is in the column always passes; with many keys more others pass too, which
    costs work further on and changes no result.
    """
    place = F.col(column) if places_of else member_place(column)
    one = (place + F.lit(1)).cast("long")  # Spark's buckets of 32,768 positions count from 1
    buckets = keys.groupBy(F.bitmap_bucket_number(one).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias("bits"))
    out = np.zeros((max(1, (places_of or MEMBER_BITS) >> 15), 1 << 12), np.uint8)
    for row in buckets.collect():  # at most 4096 rows of 4 KB
        out[row["b"] - 1] = np.frombuffer(row["bits"], np.uint8)
    return _TURNED[out].tobytes()


def places_for(count: int) -> int:
    """Positions of a filter for so many keys: a sixteenth is taken, up to ``MOST_BITS`` positions (16 MB)."""
    return min(MOST_BITS, max(MEMBER_BITS, 1 << (16 * max(1, count) - 1).bit_length()))


def maybe_member(bits: bytes, places: np.ndarray) -> np.ndarray:
    """Which of the places (``pmod(xxhash64(key), MEMBER_BITS)``) are set."""
    table = np.frombuffer(bits, np.uint8)
    return (table[places >> 3] >> (7 - (places & 7))) & 1 == 1


def member_place(column: str):
    return F.pmod(F.xxhash64(column), F.lit(MEMBER_BITS)).cast("int")


def only_members(df: DataFrame, bits: bytes, column: str, inside: bool = True) -> DataFrame:
    """Rows whose ``column`` may be (or, with ``inside`` false, surely isn't) among the filter's values. No shuffle."""

    def run(batches):
        for batch in batches:
            yield batch[maybe_member(bits, batch["_place"].to_numpy()) == inside]

    placed = df.withColumn("_place", member_place(column))
    return placed.mapInPandas(run, placed.schema).drop("_place")
