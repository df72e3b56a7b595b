"""Exact top-k: every kind of pruning against brute force, ties, odd vectors."""

import math

import numpy as np
import pytest

from shiplens.llm import topk_search as S


def brute(rows, k=5, every=50):
    good = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    queries = {}
    for i, v in good:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    out = []
    for q, v in queries.items():
        scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in good if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def search(spark, rows, **options):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(3)
    got = S.top_k(df, df.where("vec_id % 50 = 0"), **options)
    return sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got.collect())


@pytest.mark.parametrize("kind", ["unit", "varied", "clustered", "negative"])
def test_equals_brute_force(spark, kind):
    rng = np.random.default_rng(8)
    v = rng.normal(size=(400, 12))
    if kind == "unit":
        v /= np.linalg.norm(v, axis=1, keepdims=True)
    elif kind == "varied":
        v *= rng.lognormal(0, 1.5, (400, 1))
    elif kind == "clustered":
        v = v[rng.integers(0, 6, 400)] + rng.normal(size=(400, 12)) * 0.05
    else:
        v = -np.abs(v)
        v[::50] *= -1
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    assert search(spark, rows, bucket_rows=32, block_rows=3) == brute(rows)


def test_pruning_leaves_out_vectors_but_no_hit():
    rng = np.random.default_rng(2)
    v = rng.normal(size=(2000, 8)) * rng.lognormal(0, 1, (2000, 1))
    norms = np.linalg.norm(v, axis=1)
    order = np.argsort(-norms)
    v, norms = v[order], norms[order]
    pruned = 0
    for q in rng.normal(size=(40, 8)):
        scores = v @ q
        for theta in np.quantile(scores, [0.9, 0.99, 0.999]):
            kept = S.candidates(q, np.linalg.norm(q), theta, v, norms)
            assert set(np.flatnonzero(scores >= theta)) <= set(kept)
            pruned += len(v) - len(kept)
    assert pruned > 40 * 2000


def test_odd_vectors_and_ties(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5]), (0, [0.5, 1.0]), (50, [0.0, 0.0]), (100, [1.0]), (150, []), (200, None), (250, [nan, 1.0]), (300, [1.0, None]), (350, [inf, 1.0]),
        (1, [1.0, 0.5]), (2, [1.0, 0.5]), (2, [1.0, 0.5]), (3, [1.0, 0.5]), (4, [1.0, 0.5]), (5, [1.0, 0.5]), (6, [-0.001, 0.0]), (None, [9.0, 9.0]), (7, [1e-3, -1e-3]), (8, [3.0, -7.0, 2.0]),
    ]
    assert search(spark, rows) == brute(rows)
    assert search(spark, rows[:1]) == [] and search(spark, []) == []


def test_products_beyond_double_precision(spark):
    rows = [(0, [1e6, 1e6]), (1, [1e6, 1e6 + 1 / 256]), (2, [1e6, 1e6]), (3, [1e300, 1.0])]
    got = search(spark, rows)
    assert [(r, i) for _, r, i, _ in got] == [(1, 3), (2, 1), (3, 2)] and got[0][3] == 2**63 - 1
    assert got[1][3] == 256_000_000 * (256_000_000 + 256_000_001)


def test_many_equal_vectors(spark):
    rows = [(i, [0.5, 0.25]) for i in range(300)]
    assert search(spark, rows, bucket_rows=16, block_rows=2) == brute(rows)


@pytest.mark.parametrize("strata", [1, 3, 4096])
def test_blocks_meet_the_buckets_they_can_reach_and_no_others(spark, monkeypatch, strata):
    monkeypatch.setattr(S, "STRATA", strata)
    parts = 40
    rng = np.random.default_rng(5)
    tops = np.sort(rng.lognormal(0, 1, parts))[::-1].tolist()
    held = [(p, p << 24, tops[p]) for p in range(parts) if p % 7 != 3]  # some parts are empty
    buckets = spark.createDataFrame(held, "part long, bucket long, top double")
    assert S.part_count(buckets) == parts and S.part_count(buckets.limit(0)) == 1
    found = S.strata_tops(buckets, parts)
    assert len(found) == min(strata, parts)
    needs = [-math.inf, 0.0, tops[20], tops[0], tops[0] * 2, math.inf]
    rows = [(i, x, int(np.flatnonzero(found >= x).max(initial=-1)) + 1) for i, x in enumerate(needs)]
    blocks = spark.createDataFrame(rows, "block long, need double, reach long")
    got = sorted((r.block, r.bucket, r.stripe) for r in S.open_pairs(blocks, buckets, parts).collect())
    assert got == sorted((i, b, p // S.STRIPE) for i, x in enumerate(needs) for p, b, top in held if top >= x)
    # what the last stratum holds too much is all that is formed in vain
    assert all(reach == 0 for _, need, reach in rows if need > tops[0])


def test_few_strata_lose_no_hit(spark, monkeypatch):
    monkeypatch.setattr(S, "STRATA", 2)
    rng = np.random.default_rng(9)
    v = rng.normal(size=(300, 6)) * rng.lognormal(0, 1.5, (300, 1))
    rows = [(i, x) for i, x in enumerate(v.tolist())]
    assert search(spark, rows, bucket_rows=16, block_rows=2) == brute(rows)
