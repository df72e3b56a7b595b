"""Language identification: the forward sum against enumeration, held-out accuracy, edge rows."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from shiplens.llm import language_id as L

SF = "/root/testdata/sf0.1"


def every_segmentation(word, probs, langs):
    """Sum over all segmentations by plain recursion."""
    if not word:
        return np.ones(langs)
    total = np.zeros(langs)
    for k in range(1, len(word) + 1):
        p = probs.get(word[:k], np.full(langs, L.UNKNOWN) if k == 1 else None)
        if p is not None:
            total = total + p * every_segmentation(word[k:], probs, langs)
    return total


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(3)
    pieces = ["▁", "a", "b", "ab", "ba", "▁a", "▁ab", "aba", "bb", "abab"]
    probs = rng.random((len(pieces), 3)) / 5
    model = L.WordModel(pieces, probs)
    words = ["a", "b", "ab", "abab", "ababab", "cab", "bbbb", "xyz", "abaababbab"]
    want = [np.log(every_segmentation("▁" + w, dict(zip(pieces, probs)), 3)) for w in words]
    assert np.allclose(model.log_probs(words), want)


def test_long_words_do_not_underflow():
    model = L.WordModel(["a", "aa"], np.array([[1e-6], [1e-9]]))
    got = model.log_probs(["a" * 3000, "q" * 5000])
    assert np.isfinite(got).all() and got[0] < -10_000


def test_held_out_accuracy(spark):
    got = {r.doc_id: r for r in L.op8_language_id(spark, SF).collect()}
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "lang").collect()
    assert len(got) == len(docs)
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 4 == 2) and 0 <= r.score <= 1 for d, r in got.items())
    held = [(got[d.doc_id].lang_pred, d.lang) for d in docs if got[d.doc_id].held_out]
    assert len(held) > 2000 and np.mean([a == b for a, b in held]) > 0.99


def test_edge_rows(spark):
    rows = [(1, "the cat sat", "en"), (2, "die Katze", "de"), (3, None, "en"), (4, "", None), (5, "12 !!", "de"), (None, "the end", "fr"), (6, "the the", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(1)
    langs, counts = L.fit(docs)
    assert set(langs) <= {"en", "de"}
    got = {r.doc_id: r for r in L.predicted(docs.drop("lang"), langs, counts).collect()}
    assert [got[i].lang_pred for i in (3, 4, 5)] == ["und"] * 3 and got[3].lang_score == 0
    assert got[6].lang_pred in langs and len(got) == 7
    none, c = L.fit(docs.limit(0))
    assert none == [] and {r.lang_pred for r in L.predicted(docs, none, c).collect()} == {"und"}
    assert L.predicted(docs.limit(0), langs, counts).count() == 0


def test_every_language_is_learned_from_a_large_table(spark):
    rows = [(i, "the plain words of a text", "en") for i in range(3000)]
    rows += [(i, "ein paar Worte", "de") for i in range(5000, 5004)] + [(6001, "mots", "fr")] * 900
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, counts = L.fit(df, rows=20)
    assert langs == ["de", "en", "fr"] and (counts.sum(0) > 0).all()
    assert L.fit(df.limit(0))[0] == []


def test_a_long_run_that_changes_language_counts_whole():
    probs = np.array([[0.1, 0.1], [0.8, 1e-5], [1e-5, 0.8]])
    got = L.WordModel([L.SPACE, "a", "b"], probs).log_probs(["a" * 200 + "b" * 400])[0]
    want = np.log(0.1) + np.array([200 * np.log(0.8) + 400 * np.log(1e-5), 200 * np.log(1e-5) + 400 * np.log(0.8)])
    assert np.allclose(got, want)


def test_numbers_are_no_letters(spark):
    import sys

    every = "".join(chr(c) for c in range(sys.maxunicode + 1) if not 0xD800 <= c < 0xE000)
    assert "".join(L.words_of(every)) == "".join(c for c in every.lower() if c.isalpha())
    assert L.words_of("a½b c²") == ["a", "b", "c"]
    docs = spark.createDataFrame([(1, "½ ② x²³ ⅷ"), (2, "½②²"), (3, "٣ 12 _")], "doc_id long, text string")
    found = {r.doc_id: r.lang_pred for r in L.predicted(docs, ["en"], np.ones((len(L.vocabulary(L.default_model_path())), 1))).collect()}
    assert found == {1: "en", 2: "und", 3: "und"}


def test_too_many_languages_and_clashing_names_are_refused(spark):
    docs = spark.range(3).select(F.col("id").alias("doc_id"), F.lit("a b").alias("text"), F.lit("en").alias("_lang"))
    with pytest.raises(ValueError, match="of their own"):
        L.predicted(docs, ["en"], np.ones((1, 1)))
    many = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("text"), F.col("id").cast("string").alias("lang"))
    with pytest.raises(ValueError, match="languages"):
        L.fit(many)
