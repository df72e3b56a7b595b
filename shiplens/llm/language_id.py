"""Language identification by segmentation-marginalised piece unigrams.

Each language has a unigram distribution over the pieces of a fixed public
vocabulary.  The probability of a word is the sum over *all* its
segmentations into pieces, computed by a forward pass over its characters; a
text's log-probability is the sum over its words, and the score of the
predicted language is its posterior under equal priors.

Words are runs of letters, lower-cased, with the vocabulary's word mark in
front.  The forward pass runs for all distinct words of a batch at once: for
each start and length one lookup of all substrings.  A character that no
piece holds counts as an unknown piece of one character, so every word has a
probability.

Learning reads a bounded sample of texts (``TRAIN_ROWS`` in expectation, by a
hash of doc_id) outside the held-out fold, and of each language that has fewer
in it ``PER_LANGUAGE`` in expectation, one doc_id at least, so every language
is learned at any size; prediction reads every text whole.

Edge cases: a null text or one without letters is ``und`` with score 0 (a
letter is what ``str.isalpha`` calls one: no digit of any script, no fraction and
no circled number); rows without a language are not learned from; a null doc_id
counts as not held out and is not learned from; equal probabilities go to the
language first in alphabetical order; without any learnable row every text is ``und``;
more than ``MAX_LANGUAGES`` languages are refused, as the model has a column for each;
a text of any length is read whole; repeated rows have equal results and an
empty table gives no rows; other columns pass through unread, and an added
column may not have the name of one that is there (error).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.llm.common import HASHES, bounded_batches, crc_fold, hash_value, read
from shiplens.llm.lookup import KeyTable
from shiplens.llm.pieces import SPACE, default_model_path, is_plain, processor, vocabulary

TRAIN_ROWS = 8000
PER_LANGUAGE = 500
SMOOTHING = 0.1
UNKNOWN = 1e-7
MAX_LANGUAGES = 500
# runs of letters, and of numbers that aren't decimal digits: fractions, circled and Roman ones
_RUNS = re.compile(r"[^\W\d_]+")
_BASE = np.uint64(0x100000001B3)
_RESCALE = 8
_CACHE = 300_000


def words_of(text: str | None) -> list[str]:
    runs = _RUNS.findall((text or "").lower())
    if all(map(str.isalpha, runs)):
        return runs
    return [w for run in runs for w in "".join(c if c.isalpha() else " " for c in run).split()]


def _key(piece: str) -> int:
    h = 0
    for c in piece:
        h = (h * int(_BASE) + ord(c) + 1) & (2**64 - 1)
    return h


class WordModel:
    """Log-probabilities of words per language, summed over all segmentations."""

    def __init__(self, pieces: list[str], probs: np.ndarray):
        """``probs`` has a row for each piece and a column for each language."""
        self.table = KeyTable(np.array([_key(p) for p in pieces], np.uint64))
        self.probs = np.vstack([probs, np.zeros((1, probs.shape[1]))])  # index -1: no such piece
        self.longest = max(map(len, pieces))

    def log_probs(self, words: list[str]) -> np.ndarray:
        out = np.zeros((len(words), self.probs.shape[1]))
        by_length: dict[int, list[int]] = {}
        for i, w in enumerate(words):
            by_length.setdefault(len(w), []).append(i)
        for length, at in by_length.items():
            chars = np.frombuffer("".join([SPACE + words[i] for i in at]).encode("utf-32-le", "surrogatepass"), np.uint32)
            out[at] = self._forward(chars.reshape(len(at), length + 1).astype(np.uint64) + np.uint64(1))
        return out

    def _forward(self, chars: np.ndarray) -> np.ndarray:
        n, length = chars.shape
        languages = self.probs.shape[1]
        # ahead[k]: probability mass that reaches k characters past the current start
        ahead = [np.zeros((n, languages)) for _ in range(self.longest + 1)]
        ahead[0] += 1.0
        logs = np.zeros((n, languages))
        for start in range(length):
            mass = ahead.pop(0)
            ahead.append(np.zeros((n, languages)))
            if start % _RESCALE == _RESCALE - 1:
                # one scale per word and language: none underflows behind another
                scale = np.where(mass > 0, mass, 1.0)
                mass = mass / scale
                ahead = [a / scale for a in ahead]
                logs += np.log(scale)
            key = np.zeros(n, np.uint64)
            for k in range(min(self.longest, length - start)):
                key = key * _BASE + chars[:, start + k]
                piece = self.table.find(key)
                if k == 0:
                    ahead[k] += mass * np.where(piece[:, None] < 0, UNKNOWN, self.probs[piece])
                else:
                    hit = np.flatnonzero(piece >= 0)
                    ahead[k][hit] += mass[hit] * self.probs[piece[hit]]
        return np.log(np.maximum(ahead[0], 1e-300)) + logs


def piece_counts(docs: DataFrame, model: str) -> DataFrame:
    """``(lang, piece, n)`` of the vocabulary's own segmentation of ``docs(text, lang)``."""

    def counted(batches):
        sp = processor(model)
        total: dict[str, np.ndarray] = {}
        for b in batches:
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if lang not in total:
                    total[lang] = np.zeros(sp.get_piece_size(), np.int64)
                ids = sp.encode(" ".join(words_of(text)))
                np.add.at(total[lang], ids, 1)
        for lang, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at.astype(np.int32)), pa.array(n[at])], names=["lang", "piece", "n"])

    bounded_batches(docs.sparkSession)
    counts = docs.select("text", F.col("lang").cast("string")).mapInArrow(counted, "lang string, piece int, n long")
    return counts.groupBy("lang", "piece").agg(F.sum("n").alias("n"))


def fit(docs: DataFrame, rows: int = TRAIN_ROWS, model: str | None = None, per_language: int = PER_LANGUAGE) -> tuple[list[str], np.ndarray]:
    """Languages in order, and the pieces' probabilities (a row per id of the vocabulary)."""
    model = model or default_model_path()
    usable = docs.where("lang is not null and doc_id is not null").where(crc_fold("doc_id", 4) != 2)
    usable = usable.select("text", F.col("lang").cast("string").alias("lang"), hash_value(F.col("doc_id")).alias("hash"))
    # a row for each language; one too many is enough to refuse
    each = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min("hash").alias("least")).limit(MAX_LANGUAGES + 1).toArrow().to_pylist()
    if len(each) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages to learn")
    total = sum(r["n"] for r in each)
    share = {r["lang"]: min(1.0, max(rows / total, per_language / r["n"])) for r in each}
    below = [(r["lang"], max(int(share[r["lang"]] * HASHES), r["least"] + 1)) for r in each]
    limits = usable.sparkSession.createDataFrame(below, "lang string, below long")
    sample = usable.join(F.broadcast(limits), "lang").where("hash < below").select("text", "lang")
    # a row for each language and piece at most
    found = piece_counts(sample, model).toArrow()
    langs, col = np.unique(found.column("lang").to_numpy(zero_copy_only=False).astype(str), return_inverse=True)
    counts = np.zeros((len(vocabulary(model)), len(langs)))
    counts[found.column("piece").to_numpy(), col] = found.column("n").to_numpy()
    return list(langs), counts


def predicted(docs: DataFrame, langs: list[str], counts: np.ndarray, model: str | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``lang_score``; other columns pass through unread."""
    model = model or default_model_path()
    if clash := {"lang_pred", "lang_score", "_lang"} & set(docs.columns):
        raise ValueError(f"the rows have columns {sorted(clash)} of their own")
    if not langs:
        return docs.withColumns({"lang_pred": F.lit("und"), "lang_score": F.lit(0.0)})
    bounded_batches(docs.sparkSession)
    plain = [i for i, p in enumerate(vocabulary(model)) if is_plain(model, i) and (p == SPACE or p.removeprefix(SPACE).isalpha())]
    smooth = counts[plain] + SMOOTHING
    probs = smooth / smooth.sum(0)
    shared = docs.sparkSession.sparkContext.broadcast(([vocabulary(model)[i] for i in plain], probs))

    @F.pandas_udf("lang_pred string, lang_score double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        words = WordModel(*shared.value)
        at: dict[str, int] = {}
        logs = np.zeros((0, len(langs)))
        for texts in batches:
            if len(at) > _CACHE:
                at, logs = {}, logs[:0]
            found = [words_of(t) for t in texts]
            new = list({w for ws in found for w in ws if w not in at})
            at.update(zip(new, range(len(at), len(at) + len(new))))
            logs = np.vstack([logs, words.log_probs(new)])
            names, scores = [], []
            for ws in found:
                if not ws:
                    names.append("und")
                    scores.append(0.0)
                    continue
                total = logs[np.fromiter(map(at.__getitem__, ws), np.int64, len(ws))].sum(0)
                best = int(total.argmax())
                names.append(langs[best])
                scores.append(float(1 / np.exp(total - total[best]).sum()))
            yield pd.DataFrame({"lang_pred": names, "lang_score": scores})

    return docs.withColumn("_lang", score("text")).withColumns({"lang_pred": F.col("_lang.lang_pred"), "lang_score": F.col("_lang.lang_score")}).drop("_lang")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document; the held-out fold is never learned from."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    langs, counts = fit(docs)
    return predicted(docs.select("doc_id", "text"), langs, counts).select(
        "doc_id",
        F.coalesce(crc_fold("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
        "lang_pred",
        F.col("lang_score").alias("score"),
    )
