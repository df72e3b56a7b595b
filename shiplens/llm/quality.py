"""Quality classifier: hashed word n-gram logistic regression.

Words and symbol runs and their bigrams are hashed into ``2**bits`` weights.
Training is follow-the-regularised-leader (FTRL-proximal), online over the
labelled texts of each of a few shards; the shards' weights are averaged.
A score is the sparse dot product of a text's features with the weights.

Training reads a bounded sample of labelled rows (``TRAIN_ROWS`` in
expectation, chosen by a hash of doc_id, so the same on every run); scoring
reads every text whole.

Edge cases: a null or blank text has no n-grams, so its score is that of the
bias alone; labels that are null take no part; a doc_id with several labels
is learned once per different label, so repeated label rows change nothing; of
several texts under one doc_id the smallest is learned; without any label
every score is 0.5; a null doc_id is never labelled and counts as not held
out; texts of any length are read whole; an empty table gives no rows; a
column of the input named ``quality_score`` is replaced, other extra columns pass through.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import bounded_batches, crc_fold, hash_below, read

BITS = 18
TRAIN_ROWS = 6000
SHARDS = 4
EPOCHS = 8
REJECT_BELOW = 0.3
# FTRL-proximal: learning rate, its offset, L1 and L2 strengths
ALPHA, BETA, L1, L2 = 1.0, 1.0, 0.02, 0.01
_TOKEN = re.compile(r"\w+|[^\w\s]+")
_CACHE = 200_000


class _Hashes(dict):
    """Hash of each word seen, emptied when it holds too many."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = zlib.crc32(word.encode("utf-8", "surrogatepass"))
        return value


def features(text: str | None, hashes: dict, bits: int = BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed n-grams of ``text`` and their values (root of the share, so unit length).

    A bigram of a word with itself is one "repeat" gram, whatever the word.
    """
    found = _TOKEN.findall(text or "")
    words = np.fromiter(map(hashes.__getitem__, found), np.uint64, len(found))
    pairs = words[:-1] * np.uint64(0x9E3779B97F4A7C15) + words[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs[words[:-1] == words[1:]] = np.uint64(0x5851F42D4C957F2D)
    grams = np.concatenate([words * np.uint64(0xD6E8FEB86659FD93), pairs]) >> np.uint64(64 - bits)
    index, counts = np.unique(grams.astype(np.int64), return_counts=True)
    return index, np.sqrt(counts / max(len(grams), 1))


def train_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], bits: int = BITS, epochs: int = EPOCHS) -> np.ndarray:
    """Weights (bias last) after ``epochs`` passes over ``(index, value, label)`` rows in order."""
    z, n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(i):
        shrunk = np.sign(z[i]) * np.maximum(np.abs(z[i]) - L1, 0)
        return -shrunk / ((BETA + np.sqrt(n[i])) / ALPHA + L2)

    for _ in range(epochs):
        for index, value, label in rows:
            i, x = np.append(index, 1 << bits), np.append(value, 1.0)
            w = weights(i)
            p = 1 / (1 + np.exp(-np.clip(w @ x, -35, 35)))
            g = (p - label) * x
            z[i] += g - (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / ALPHA * w
            n[i] += g * g
    return weights(slice(None))


def fit(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, shards: int = SHARDS, bits: int = BITS) -> np.ndarray:
    """Weights learned from ``labels(doc_id, quality)`` of documents outside the held-out fold."""
    usable = labels.where("quality is not null and doc_id is not null").where(crc_fold("doc_id", 5) != 0)
    # a label counts once per document, however often its row repeats
    usable = usable.select(F.col("doc_id").cast("long"), F.col("quality").cast("int").alias("label")).distinct()
    total = usable.count()
    # about `rows` different (doc_id, label) pairs are sampled, so this side of the join is small by construction
    sample = usable.where(hash_below(F.col("doc_id"), min(1.0, rows / max(total, 1))))
    bounded_batches(docs.sparkSession)
    texts = docs.select(F.col("doc_id").cast("long"), "text").join(F.broadcast(sample), "doc_id")
    # one text for each sampled pair, so a shard's rows follow the sample and not a repeated doc_id
    texts = texts.groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    ordered = texts.select(F.pmod(F.xxhash64("doc_id"), F.lit(shards)).alias("shard"), "doc_id", "text", "label")
    ordered = ordered.repartition(shards, "shard").sortWithinPartitions("shard", "doc_id", "label", "text")

    def learned(batches):
        hashes, rows_of = _Hashes(), {}
        for b in batches:
            for shard, text, label in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                rows_of.setdefault(shard, []).append((*features(text, hashes, bits), label))
        for shard in rows_of:
            w = train_ftrl(rows_of[shard], bits)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), shard, np.int32)), pa.array(at.astype(np.int32)), pa.array(w[at])], names=["shard", "at", "w"])

    # at most shards x 2**bits rows, averaged to 2**bits + 1 before they reach the driver
    parts = ordered.mapInArrow(learned, "shard int, at int, w double")
    model = parts.groupBy("at").agg(F.sum("w").alias("w")).toArrow()
    out = np.zeros((1 << bits) + 1)
    out[model.column("at").to_numpy()] = model.column("w").to_numpy() / shards
    return out


def scored(docs: DataFrame, weights: np.ndarray, text: str = "text", bits: int = BITS) -> DataFrame:
    """``docs`` with a column ``quality_score`` of the column ``text``; others pass through unread."""
    bounded_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        hashes, w = _Hashes(), shared.value
        for texts in batches:
            out = np.empty(len(texts))
            for k, text in enumerate(texts):
                index, value = features(text, hashes, bits)
                out[k] = w[index] @ value + w[-1]
            yield pd.Series(1 / (1 + np.exp(-np.clip(out, -35, 35))))

    return docs.withColumn("quality_score", score(text))


def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document; labels of the held-out fold are never read."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    weights = fit(docs, read(spark, sf_dir, "labels"))
    return scored(docs, weights).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", 5) == 0, F.lit(False)).alias("held_out"),
        F.col("quality_score").alias("score"),
        (F.col("quality_score") >= REJECT_BELOW).cast("int").alias("predicted"),
    )
