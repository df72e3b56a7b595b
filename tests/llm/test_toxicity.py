import itertools

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shiplens.llm import toxicity

MOVES = np.array([-1.0, 0.4, 0.7])


def path_score(tags, scores, moves):
    before, total = 0, 0.0
    for t, s in zip(tags, scores, strict=True):
        total += s if t else 0
        total += {(0, 1): moves[0], (1, 0): moves[1], (1, 1): moves[2]}.get((before, t), 0)
        before = t
    return total


@settings(deadline=None, max_examples=100)
@given(st.lists(st.lists(st.floats(-5, 5), min_size=1, max_size=7), min_size=1, max_size=4))
def test_chain_equals_enumeration(texts):
    scores = np.array([s for t in texts for s in t])
    first = np.array([k == 0 for t in texts for k in range(len(t))])
    chain = toxicity.Chain(scores, first, MOVES)
    marginals, logs, moves = [], [], np.zeros(3)
    for t in texts:
        paths = list(itertools.product((0, 1), repeat=len(t)))
        weight = np.exp([path_score(p, t, MOVES) for p in paths])
        logs.append(np.log(weight.sum()))
        weight /= weight.sum()
        marginals += list(weight @ np.array(paths))
        for p, w in zip(paths, weight, strict=True):
            for pair in zip((0, *p), p, strict=False):
                moves += w * np.array([pair == (0, 1), pair == (1, 0), pair == (1, 1)])
    np.testing.assert_allclose(chain.marginals(), marginals, atol=1e-9)
    np.testing.assert_allclose(chain.log_z(), logs, atol=1e-9)
    np.testing.assert_allclose(chain.moves(), moves, atol=1e-9)


def test_long_chains_stay_finite_and_exact():
    rng = np.random.default_rng(3)
    scores = rng.normal(0, 20, 200_000)
    first = rng.random(200_000) < 1e-4
    first[0] = True
    chain = toxicity.Chain(scores, first, MOVES)
    x, ratio = 0.0, np.empty(len(scores))
    for t in range(len(scores)):
        x = (chain.ot[t] + chain.tt[t] * x) / (1 + chain.to[t] * x)
        ratio[t] = x
    np.testing.assert_allclose(chain.ratio, ratio, rtol=1e-9)
    assert np.isfinite(chain.log_z()).all() and ((chain.marginals() >= 0) & (chain.marginals() <= 1)).all()


def test_gradient_equals_differences():
    bits, words = 6, ["fine", "awful", "day", "awfully", "so"]
    own, last, after = toxicity._indexes(words, bits)
    codes = np.array([0, 2, 1, 4, 3, 2, 0, 1])
    toxic = np.array([0, 0, 1, 1, 1, 0, 0, 1], bool)
    first = np.array([1, 0, 0, 0, 0, 1, 0, 0], bool)
    blocks = [(codes, toxic, first, own, last, after)]
    x = np.random.default_rng(1).normal(0, 0.5, (1 << bits) + 4)
    _, g = toxicity.loss_and_gradient(x, blocks, bits)
    for i in range(len(x)):
        step = np.zeros(len(x))
        step[i] = 1e-5
        up, down = (toxicity.loss_and_gradient(x + k * step, blocks, bits)[0] for k in (1, -1))
        assert abs((up - down) / 2e-5 - g[i]) < 1e-5


def test_minimised_finds_the_least_value():
    a = np.diag([1.0, 10.0, 100.0])
    x = toxicity.minimised(lambda x: (0.5 * x @ a @ x - x.sum(), a @ x - 1), np.zeros(3), steps=60)
    np.testing.assert_allclose(x, [1, 0.1, 0.01], atol=1e-3)


def corpus():
    rng = np.random.default_rng(8)
    plain = [a + b for a in ("ta", "ro", "mi", "sen", "lu") for b in ("ka", "de", "vi", "no", "sa", "pul")]
    bad = ["vile" + x for x in ("st", "ness", "ra", "do", "mi", "", "ka")] + ["scum"]
    docs, labels = [], []
    for i in range(900):
        words = list(rng.choice(plain, rng.integers(3, 60)))
        toxic = int(i % 4 == 0)
        for _ in range(rng.integers(1, 4) if toxic else 0):
            words.insert(rng.integers(0, len(words) + 1), str(rng.choice(bad)).upper() if i % 8 else str(rng.choice(bad)))
        docs.append((i, " ".join(words)))
        labels.append((i, 1, toxic))
    # copies of one toxic text: their other words are no evidence
    docs += [(1000 + k, "the zebra crosses vilest rivers quietly") for k in range(40)]
    labels += [(1000 + k, 1, 1) for k in range(40)]
    docs += [(2000, None), (2001, " .. "), (None, "scum"), (2002, "zebra rivers " + "taka " * 3000), (2003, "senka SCUM vileness, roka"), (2004, "scum"), (2004, "taka")]
    labels += [(2002, 1, 0), (2003, 0, None), (None, 1, 1), (2004, 1, 0), (2004, 1, 1), (3, 0, 0)]
    return docs, labels


def write(spark, path, docs, labels):
    docs = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "'x' as score", "1 as toxicity")
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")


def test_query_learns_spans_and_spares_clean_texts(spark, tmp_path):
    docs, labels = corpus()
    write(spark, tmp_path, docs, labels)
    rows = toxicity.op13_toxicity(spark, str(tmp_path)).collect()
    assert len(rows) == len(docs)
    of = {}
    for r in rows:
        of.setdefault(r.doc_id, []).append(r)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5)
    label = {i: t for i, _, t in labels[:900]}
    held = [of[i][0] for i in range(900) if of[i][0].held_out]
    assert len(held) > 100 and all(r.predicted == label[r.doc_id] for r in held)
    assert [s.score for s in of[2000] + of[2001]] == [0, 0]
    assert of[2002][0].predicted == 0 and of[None][0].held_out is False
    texts = {i: t for i, t in docs}
    spans = [texts[2003][s.start : s.end] for s in of[2003][0].spans]
    assert spans == ["SCUM vileness"]
    assert {texts[1000][s.start : s.end] for s in of[1000][0].spans} == {"vilest"}


def test_labels_of_the_held_out_fold_change_nothing(spark, tmp_path):
    docs, labels = corpus()
    import zlib

    held = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 0
    turned = [(i, q, None if t is None else 1 - t) if held(i) else (i, q, t) for i, q, t in labels]
    found = []
    for k, some in enumerate((labels, turned)):
        frame = spark.createDataFrame(docs, "doc_id long, text string")
        sample = toxicity.labelled_texts(frame, spark.createDataFrame(some, "doc_id long, quality int, toxic int"))
        found.append(sorted(tuple(r) for r in sample.collect()))
    assert found[0] == found[1] and len(found[0]) > 500


def test_without_labels_and_empty(spark, tmp_path):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert [r.toxicity.score for r in toxicity.tagged(docs, model).collect()] == [0, 0]
    one = spark.createDataFrame([(1, 1)], "doc_id long, toxic int")
    assert toxicity.fit(docs, one).vector is None
    assert toxicity.tagged(docs.limit(0), model).collect() == []
    with pytest.raises(ValueError, match="name another"):
        toxicity.tagged(docs.withColumn("toxicity", F.lit(1)), model)
