"""Mixing: fitted rates against a dense solver, targets met, edge rows, no Python in the plan."""

import numpy as np
import pytest

from shiplens.llm import mixing as M
from tests.conftest import SF_CHECK


def plain_rates(t, p, share, steps):
    """Projected gradient with momentum on dense arrays, in the same metric."""
    a = (t[:, None] * p).T
    wanted = share * t.sum()
    inverse = np.linalg.pinv(np.einsum("i,ia,ib->ab", t, p, p), rcond=1e-10)
    w = before = np.ones(len(t))
    momentum, best = 1.0, np.inf
    for _ in range(steps):
        rest = a @ w - wanted
        if rest @ inverse @ rest > best:
            momentum = 1.0
        best = rest @ inverse @ rest
        after = (1 + np.sqrt(1 + 4 * momentum**2)) / 2
        y = w + (momentum - 1) / after * (w - before)
        momentum = after
        before, w = w, np.maximum(0, y - p @ (inverse @ (a @ y - wanted)))
    return w, a, wanted


def some_posteriors(spark, n=120):
    rng = np.random.default_rng(4)
    t = rng.integers(1, 500, n).astype(float)
    p = rng.dirichlet([0.15] * 3, n)
    df = spark.createDataFrame([(float(a), *map(float, b)) for a, b in zip(t, p)], "_tokens double, _p0 double, _p1 double, _p2 double")
    return df, t, p


@pytest.mark.parametrize("share", [[0.5, 0.3, 0.2], [0.9, 0.06, 0.04]])
def test_rates_equal_dense_projected_gradient(spark, share):
    df, t, p = some_posteriors(spark)
    fit = M.fit_rates(df.coalesce(1), dict(zip("abc", share)), max_steps=20, stage_every=7)
    got = np.array([r.w for r in df.select(M.rate_pair(fit.steps, 3)["w"].alias("w")).collect()])
    w, a, wanted = plain_rates(t, p, np.array(share), len(fit.steps))
    assert got.min() >= 0 and np.allclose(got, w, atol=1e-6)
    assert np.allclose((a @ got - wanted) / wanted.sum(), fit.missed, atol=1e-9)


def test_far_targets_are_reached_or_told(spark):
    df, t, p = some_posteriors(spark, 400)
    df = df.coalesce(1)
    fit = M.fit_rates(df, dict(zip("abc", [0.97, 0.02, 0.01])))
    assert fit.reached and np.abs(fit.missed).max() <= M.TOLERANCE and len(fit.steps) > 60
    # every document has some of every domain, so a domain can't be left out whole
    out = M.fit_rates(df, {"a": 1.0, "b": 0.0, "c": 0.0}, max_steps=10)
    assert not out.reached and np.abs(out.missed).max() > M.TOLERANCE


def test_targets_out_of_reach_are_raised_or_warned(spark):
    docs = spark.createDataFrame([(i, "the thing and more") for i in range(30)], "doc_id long, text string")
    labelled = docs.selectExpr("text", "'a' as domain")
    with pytest.raises(M.OutOfReach, match="b -0.5"):
        M.rated(docs, labelled, {"a": 0.5, "b": 0.5}, strict=True)
    with pytest.warns(UserWarning, match="targets missed"):
        M.rated(docs, labelled, {"a": 0.5, "b": 0.5})


def test_a_rare_domain_is_sampled(spark):
    rows = [(i, "t", "en") for i in range(3000)] + [(5000 + i, "t", "de") for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    got = {r["domain"]: r["count"] for r in M.labelled_sample(docs, docs.select("doc_id"), rows=200, per_domain=20).groupBy("domain").count().collect()}
    assert got["de"] == 12 and 120 < got["en"] < 300


def test_query_meets_the_targets(spark):
    rows = M.op5_soft_mixing(spark, SF_CHECK).collect()
    assert len(rows) == 1000
    total = sum(r.n_tokens * r.rate for r in rows)
    for d, share in M.TARGETS.items():
        assert sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) / total == pytest.approx(share, abs=1e-4)
        assert sum(r.n_tokens * r.copies * r[f"p_{d}"] for r in rows) / total == pytest.approx(share, abs=0.06)
    assert all(abs(sum(r[f"p_{d}"] for d in M.TARGETS) - 1) < 1e-9 and 0 <= r.copies - r.rate + 1 <= 2 for r in rows)
    langs = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF_CHECK}/documents.parquet").collect()}
    assert np.mean([max(M.TARGETS, key=lambda d: r[f"p_{d}"]) == langs[r.doc_id] for r in rows]) > 0.95


def test_stage_repeats_rows_with_their_columns(spark):
    docs = spark.createDataFrame([(i, ("the thing which " if i % 4 else "ich schlei über ") * 9, i % 3, "x", 1) for i in range(80)], "doc_id long, text string, copies int, `_p0` string, id int")
    labelled = docs.selectExpr("text", "case when doc_id % 4 = 0 then 'de' else 'en' end as domain")
    got = M.mixed(docs, labelled, {"de": 0.5, "en": 0.5})
    assert got.columns == docs.columns
    rows = got.collect()
    german = [r.doc_id for r in rows if r.doc_id % 4 == 0]
    assert 0.35 < len(german) / len(rows) < 0.65 and len(german) > len(set(german))
    assert all(r.copies == r.doc_id % 3 and r._p0 == "x" for r in rows)


def test_edge_rows(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "the thing"), (3, "ei " * 50_000), (3, "ei " * 50_000)], "doc_id long, text string")
    none = docs.selectExpr("text", "cast(null as string) as domain")
    got = M.rated(docs, none, {"a": 0.5, "b": 0.5}).collect()
    assert len(got) == 5 and all(r._p0 == 0.5 for r in got)
    assert len({r.copies for r in got if r.id == 3}) == 1
    one = M.rated(docs, docs.selectExpr("text", "'a' as domain"), {"a": 0.5, "b": 0.5}).collect()
    assert all(r._p0 == 1.0 and r._p1 == 0.0 for r in one)
    assert M.rated(docs.limit(0), none, {"a": 0.5, "b": 0.5}).count() == 0
    assert M.mixed(docs.limit(0), none).count() == 0


def test_no_python_in_the_plan(spark):
    plan = M.op5_soft_mixing(spark, SF_CHECK)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
