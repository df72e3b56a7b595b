import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from shiplens.llm import phrases


def brute(rows, least=30, subsumed=80):
    count, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in range(1, 5):
                for i in range(len(words) - k + 1):
                    count[lang, tuple(words[i : i + k])] += 1
    out = []
    often = {(lang, p): f for (lang, p), f in count.items() if f >= least and len(p) > 1}
    for (lang, p), a in often.items():
        longer = [f for (x, w), f in often.items() if x == lang and len(w) > len(p) and any(w[i : i + len(p)] == p for i in range(len(w)))]
        if any(100 * f >= subsumed * a for f in longer):
            continue
        cuts = [(2000000 * a // (count[lang, p[:k]] + count[lang, p[k:]]), k, count[lang, p[:k]], count[lang, p[k:]]) for k in range(1, len(p))]
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(p), a, left, right, n[lang], score))
    return sorted(out)


def texts(seed, size):
    rnd = random.Random(seed)
    words = ["a", "b", "Cé", "d\x01", "ÉE", "f\xa0g", " "]
    rows = [(None, None), ("en", ""), ("en", " . ,"), ("und", "a b a b"), ("x y", "a b Cé " * 12)]
    for _ in range(size):
        parts = [rnd.choice(["a b Cé", "a b", "Cé d\x01 a b", *words]) for _ in range(rnd.randint(0, 30))]
        rows.append((rnd.choice(["en", "fr", None]), "".join(p + rnd.choice([" ", " ", "\t ", ", ", "\r", ".!"]) for p in parts)))
    return rows + rows[5:9]


@pytest.mark.parametrize("least, subsumed", [(30, 80), (5, 60)])
def test_equals_brute_force(spark, least, subsumed):
    rows = texts(least, 150)
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).repartition(4)
    got = phrases.collocations(docs, least, subsumed, 10**6).select("lang", "phrase", "a", "l", "r", "n", "score").collect()
    want = brute(rows, least, subsumed)
    assert sorted(map(tuple, got)) == want and len(want) > 10


def test_small_runs_and_sieves_give_the_same(spark, monkeypatch):
    rows = texts(9, 120)
    monkeypatch.setattr(phrases, "RUN_KEYS", 50)
    monkeypatch.setattr(phrases, "MAX_BITS", 64)  # a sieve that lets nearly all pass
    monkeypatch.setattr(phrases, "BLOCK_BYTES", 300)
    docs = spark.createDataFrame(rows, "lang string, text string")
    got = phrases.collocations(docs, 10, top=10**6).select("lang", "phrase", "a", "l", "r", "n", "score").collect()
    assert sorted(map(tuple, got)) == brute(rows, 10)


def test_ranks_break_ties_by_count_and_bytes(spark):
    rows = [("en", p, a, s) for s, a in ((5, 40), (5, 50), (9, 30)) for p in ("z z", "é a", "a b", "a\x01")]
    rows += [("fr", f"w{i:04d} x", 30, 7) for i in range(2100)]
    got = phrases.top_phrases(spark.createDataFrame(rows, "lang string, phrase string, a long, score long")).collect()
    want = []
    for lang in ("en", "fr"):
        mine = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[3], -r[2], r[1].encode()))[:2000]
        want += [(*r, k + 1) for k, r in enumerate(mine)]
    assert sorted(map(tuple, got)) == sorted(want)


def test_exact_beyond_64_bits(spark):
    big = 3 * 10**13
    words = spark.createDataFrame([("en", "a", big + 1), ("en", "b", big + 2), ("en", None, 9 * big)], "lang string, phrase string, a long")
    pairs = spark.createDataFrame([("en", "a b", big)], "lang string, phrase string, a long")
    got = phrases.scored_phrases(words, pairs).collect()
    assert [r.score for r in got] == [2000000 * big // (2 * big + 3)]


def test_empty_tables(spark):
    for rows in ([], [("en", None)], [("en", "one")]):
        assert phrases.collocations(spark.createDataFrame(rows, "lang string, text string")).collect() == []


def test_block_links_words_of_one_piece():
    block = phrases.Block(pa.array(["x", "y", "x"]), pa.array([b"A b.c", b"", b"d e"], pa.binary()))
    assert [block.words[i].as_py() for i in block.codes] == [b"a", b"b", b"c", b"d", b"e"]
    assert list(block.linked) == [True, False, False, True, False]
    assert [block.langs[i].as_py() for i in block.lang] == ["x"] * 5
    assert len(np.unique(block.keys())) == 5
