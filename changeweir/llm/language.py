"""Language identification by string kernels.

The kernel of two texts counts the character n-grams of several lengths (a blended spectrum) that both have, by presence,
over the root of the product of their own counts. Landmark texts give the Nyström map K(x, L) K(L, L)^(-1/2);
one ridge regression a language is fitted on it. As the kernel to the landmarks is a product with their
presence vectors, all of it folds into one matrix, and a batch of texts is scored by one matrix product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from changeweir.llm.common import mixed, small_batches

#: Hashed n-gram space, n-gram lengths, ridge.
SPACE, LENGTHS, RIDGE = 1 << 15, (2, 3, 4), 1e-3
#: Labelled documents that are learnt from, by language (the bound of the fit), and how many of all of them are landmarks.
TRAIN_PER_LANGUAGE, LANDMARKS = 300, 200
UNKNOWN = "und"


def letters(text: str | None) -> np.ndarray:
    """Code points of the lower-cased text with each run of other characters than letters as one blank, blanks around.

    Empty if there is no letter.
    """
    if not text:
        return np.empty(0, np.uint32)
    codes = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    ascii_letter = (codes >= 97) & (codes <= 122)
    letter = ascii_letter.copy()
    for c in np.unique(codes[codes >= 128]):
        if chr(c).isalpha():
            letter |= codes == c
    if not letter.any():
        return np.empty(0, np.uint32)
    codes = np.concatenate(([32], np.where(letter, codes, 32), [32])).astype(np.uint32)
    return codes[np.concatenate(([True], (codes[1:] != 32) | (codes[:-1] != 32)))]


def presence(text: str | None) -> np.ndarray:
    """Which hashed n-grams a text has (bool, ``SPACE``); all false if it has no letters."""
    out = np.zeros(SPACE, bool)
    codes = letters(text).astype(np.uint64)
    for n in LENGTHS:
        if len(codes) >= n:
            h = np.full(len(codes) - n + 1, n, np.uint64)
            for j in range(n):
                h = h * np.uint64(0x100000001B3) ^ codes[j : len(codes) - n + 1 + j]
            out[(mixed(h) >> np.uint64(40)).astype(np.int64) & (SPACE - 1)] = True
    return out


class Classifier:
    """``weights`` (n-gram space x languages) folds landmarks, Nyström map and ridge regression; ``bias`` is a language's mean."""

    def __init__(self, languages: list[str], weights: np.ndarray, bias: np.ndarray):
        self.languages, self.weights, self.bias = languages, weights.astype(np.float32), bias

    @classmethod
    def fit(cls, flags: np.ndarray, langs: list[str]) -> Classifier:
        languages = sorted(set(langs))
        x = flags.astype(np.float32)
        x /= np.sqrt(np.maximum(x.sum(axis=1, keepdims=True), 1))
        marks = x[np.linspace(0, len(x) - 1, min(LANDMARKS, len(x))).astype(int)]
        values, vectors = np.linalg.eigh((marks @ marks.T).astype(np.float64))
        good = values > 1e-8 * max(values.max(), 1e-12)
        root = vectors[:, good] / np.sqrt(values[good])
        mapped = (x @ marks.T).astype(np.float64) @ root
        y = np.array([[1.0 if lang == one else -1.0 for one in languages] for lang in langs])
        centre, mean = mapped.mean(axis=0), y.mean(axis=0)
        z = mapped - centre
        beta = np.linalg.solve(z.T @ z + RIDGE * len(x) * np.eye(z.shape[1]), z.T @ (y - mean))
        return cls(languages, marks.T.astype(np.float64) @ (root @ beta), mean - centre @ beta)

    def score(self, flags: np.ndarray) -> np.ndarray:
        """(texts, languages) values of the regressions, by one matrix product."""
        own = np.sqrt(np.maximum(flags.sum(axis=1, keepdims=True), 1))
        return flags.astype(np.float32) @ self.weights / own + self.bias


def _features(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        yield pd.DataFrame({"lang": batch["lang"], "bits": [np.packbits(presence(t)).tobytes() for t in batch["text"]]})


def held_out(doc_id: Column) -> Column:
    """crc32 of doc_id as text, modulo 5, is 0; a null doc_id counts as the empty text, whose crc32 is 0."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % 5 == 0


def train(docs: DataFrame, per_language: int = TRAIN_PER_LANGUAGE) -> Classifier | None:
    """Fits on at most ``per_language`` labelled documents of each language that are not held out, picked by hash of doc_id and text.

    The driver gets 4 KB a picked document, whatever its length. None if there is nothing to learn from.
    """
    usable = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id")))
    # Equal rows are one; each task cuts its own rows to as many a language before they are ranked.
    usable = usable.select("lang", "text", F.xxhash64("doc_id", "text").alias("h"))
    by_hash = Window.partitionBy("lang").orderBy("h")
    picked = usable.select("lang", "h").distinct().withColumn("r", F.row_number().over(by_hash)).where(F.col("r") <= per_language)
    picked = [r.h for r in picked.select("h").distinct().collect()]
    if not picked:
        return None
    rows = usable.where(F.col("h").isin(picked)).dropDuplicates(["lang", "h"]).select("lang", "text").mapInPandas(_features, "lang string, bits binary")
    rows = sorted((r.lang, r.bits) for r in rows.collect())
    flags = np.unpackbits(np.frombuffer(b"".join(b for _, b in rows), np.uint8).reshape(len(rows), -1), axis=1).astype(bool)
    lettered = flags.any(axis=1)
    if not lettered.any():
        return None
    return Classifier.fit(flags[lettered], [lang for (lang, _), ok in zip(rows, lettered, strict=True) if ok])


def predict(docs: DataFrame, model: Classifier | None) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every row of ``docs``, from the whole text alone.

    A null text and one without letters are ``und`` with score 0, as is everything if there is no model. The score is the
    share of the best language in a softmax of the regressions. Ties go to the first language by name.
    """
    parts = (model.languages, model.weights, model.bias) if model else None
    shared = docs.sparkSession.sparkContext.broadcast(parts)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        fitted = Classifier(*shared.value) if shared.value else None
        for batch in batches:
            langs, scores = [UNKNOWN] * len(batch), np.zeros(len(batch))
            texts = batch["text"].tolist()
            for at in range(0, len(texts) if fitted else 0, 64):
                flags = np.stack([presence(t) for t in texts[at : at + 64]])
                values = fitted.score(flags)
                best = values.argmax(axis=1)
                share = np.exp(4 * (values - values.max(axis=1, keepdims=True)))
                share = share.max(axis=1) / share.sum(axis=1)
                for i in np.flatnonzero(flags.any(axis=1)):
                    langs[at + i], scores[at + i] = fitted.languages[best[i]], share[i]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "held_out": batch["held_out"], "lang_pred": langs, "score": scores})

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out(F.col("doc_id")).alias("held_out"), "text")
    return rows.mapInPandas(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Trains on the labelled documents that are not held out and predicts every document."""
    small_batches(docs.sparkSession)
    return predict(docs, train(docs))
