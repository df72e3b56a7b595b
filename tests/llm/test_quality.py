"""Quality classifier: held-out accuracy, folds, and edge rows."""

import zlib

import numpy as np

from shiplens.llm import quality as Q

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy_and_folds(spark):
    got = {r.doc_id: r for r in Q.op7_quality_classifier(spark, SF).collect()}
    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    assert len(got) == 10_000
    assert all(r.held_out == (zlib.crc32(str(d).encode()) % 5 == 0) for d, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[x.doc_id], x.quality) for x in labels if got[x.doc_id].held_out]
    good = [r for r, q in held if q == 1]
    bad = [r for r, q in held if q == 0]
    assert len(good) > 500 and len(bad) > 100
    assert np.mean([r.predicted == 1 for r in good]) > 0.99
    assert np.mean([r.predicted == 0 for r in bad]) > 0.9


def test_labels_of_the_held_out_fold_change_nothing(spark):
    docs = spark.createDataFrame([(i, f"word{i % 5} !! {'x' * (i % 3)}") for i in range(60)], "doc_id long, text string")
    rows = [(i, i % 2) for i in range(60)]
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 5 == 0 else q) for i, q in rows]
    a, b = (Q.fit(docs, spark.createDataFrame(x, "doc_id long, quality int")) for x in (rows, flipped))
    assert np.array_equal(a, b) and a.any()


def test_features_are_whole_text_unit_vectors():
    h = Q._Hashes()
    index, value = Q.features("a b a b c", h)
    assert np.isclose((value**2).sum(), 1)
    assert len(Q.features("", h)[0]) == len(Q.features(None, h)[0]) == 0
    long = "w " * 200_000
    assert not np.array_equal(Q.features(long, h)[1], Q.features(long + "tail", h)[1])
    same, _ = Q.features("x x x", h)
    other, _ = Q.features("y y y", h)
    assert len(set(same) & set(other)) == 1  # the repeat gram


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "text"), (3, "t " * 50_000), (3, "t " * 50_000)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (2, 1), (2, 0)], "doc_id long, quality int")
    w = Q.fit(docs, labels)
    got = Q.scored(docs.withColumnRenamed("doc_id", "quality_score"), w).collect()
    assert len(got) == 5 and all(0 <= r.quality_score <= 1 for r in got)
    none = Q.fit(docs.limit(0), labels.limit(0))
    assert not none.any() and Q.scored(docs, none).first().quality_score == 0.5


def test_repeated_rows_of_a_document_change_nothing(spark):
    docs = [(i, f"word{i % 5} !! {'x' * (i % 3)}") for i in range(60)]
    labels = [(i, i % 2) for i in range(60)]
    hot = [(7, docs[7][1])] * 500 + [(7, "zzz, a later text")] * 500
    made = [
        Q.fit(spark.createDataFrame(d, "doc_id long, text string"), spark.createDataFrame(x, "doc_id long, quality int"))
        for d, x in ((docs, labels), (docs + hot, labels + [(7, 1)] * 1000))
    ]
    assert np.array_equal(*made) and made[0].any()


def plain_ftrl(rows, bits, epochs):
    """The published per-coordinate update, one weight at a time."""
    z, n = {}, {}

    def weight(i):
        zi = z.get(i, 0.0)
        if abs(zi) <= Q.L1:
            return 0.0
        return -(zi - np.sign(zi) * Q.L1) / ((Q.BETA + np.sqrt(n.get(i, 0.0))) / Q.ALPHA + Q.L2)

    for _ in range(epochs):
        for index, value, label in rows:
            x = [*zip(index.tolist(), value.tolist()), (1 << bits, 1.0)]
            w = {i: weight(i) for i, _ in x}
            p = 1 / (1 + np.exp(-sum(w[i] * v for i, v in x)))
            for i, v in x:
                g = (p - label) * v
                sigma = (np.sqrt(n.get(i, 0.0) + g * g) - np.sqrt(n.get(i, 0.0))) / Q.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * w[i]
                n[i] = n.get(i, 0.0) + g * g
    return {i: weight(i) for i in z}


def test_training_and_scores_equal_plain_loops(spark):
    rng = np.random.default_rng(2)
    texts = [" ".join(rng.choice(["good", "plain", "!!", "buy", "now", "words"], rng.integers(0, 12))) for _ in range(60)]
    labels = [int("buy" not in t) for t in texts]
    hashes, bits = Q._Hashes(), 10
    rows = [(*Q.features(t, hashes, bits), y) for t, y in zip(texts, labels)]
    got = Q.train_ftrl(rows, bits, epochs=3)
    want = plain_ftrl(rows, bits, 3)
    assert np.allclose([got[i] for i in want], list(want.values()), atol=1e-12)
    assert not np.delete(got, list(want)).any() and any(want.values())
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    for r, (index, value, _) in zip(Q.scored(df, got, bits=bits).collect(), rows):
        z = sum(got[i] * v for i, v in zip(index, value)) + got[-1]
        assert abs(r.quality_score - 1 / (1 + np.exp(-z))) < 1e-6
