"""The corpus pipeline: each stage calls one operator of ``shiplens.llm``.

Every stage function takes ``(spark, docs, sf_dir)`` and returns a DataFrame.
Between stages the rows are written as Parquet and read again, so a stage
never recomputes the one before it.  All stages but the last return the
columns of ``documents``.

Edge cases are those of the operators: null and empty texts are scored,
grouped and encoded like any other; a null doc_id is a value of its own;
empty tables give empty stages; extra columns pass through all stages but
the last, which returns its own columns; a text of any length stays whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm import exact_dedup, mixing, piece_codec, quality, simhash
from shiplens.llm.common import as_row, from_row, read, staged


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go."""
    weights = quality.fit(docs, read(spark, sf_dir, "labels"))
    rows = quality.scored(as_row(docs), weights, text="row.text")
    return from_row(rows.where(F.col("quality_score") >= quality.REJECT_BELOW))


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts one row stays."""
    return exact_dedup.exact_dedup(docs)


def simhash_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate component stays (the smallest doc_id)."""
    return simhash.near_dedup(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are dropped or repeated until the domains' tokens meet their target weights."""
    return mixing.mixed(docs, mixing.labelled_sample(docs, read(spark, sf_dir, "labels")))


def pieces_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of each document under seeded merge-dropout, and the digest of the text they decode to."""
    back = piece_codec.decoded(piece_codec.encoded(docs))
    rows = back.withColumns({"decoded_sha256": F.sha2("decoded_text", 256), "n_pieces": F.size("piece_ids")})
    return rows.select("doc_id", "lang", "source", "piece_ids", "n_pieces", "decoded_sha256")


STAGES = [
    ("quality classifier", quality_stage),
    ("exact dedup", exact_stage),
    ("simhash near-dedup", simhash_stage),
    ("mixing to target weights", mixing_stage),
    ("sentencepiece pieces", pieces_stage),
]

# Trained scores, fingerprints and segmentations have no SQL; see tests/llm/test_pipeline.py.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are staged for the next."""
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = staged(docs, f"pipeline-{i}")
    return docs
