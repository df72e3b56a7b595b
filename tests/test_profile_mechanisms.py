"""Two-scan profile, co-moment blocks, binned density, quantile sketches, CSV quarantine."""

import math
import os

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens import fixtures
from shiplens.operators import comoments, model as ml, profile, quantiles, sketches
from shiplens.plans import jobs
from shiplens.sinks.files import write_csv
from shiplens.sources.tables import read_csv_tagged
from tests.conftest import SF_SMALL

INF, NAN = float("inf"), float("nan")


def holey(k, n=400, seed=2):
    rng = np.random.default_rng(seed)
    x = rng.normal(0, 1, (n, k)) @ rng.normal(0, 1, (k, k)) + rng.normal(0, 1e6, k)
    x[rng.random((n, k)) < 0.2] = np.nan
    return x


def plain_r(x):
    k = x.shape[1]
    out = np.full((k, k), np.nan)
    for i in range(k):
        for j in range(k):
            both = np.isfinite(x[:, i]) & np.isfinite(x[:, j])
            if both.sum() > 1 and np.ptp(x[both, i]) and np.ptp(x[both, j]):
                out[i, j] = np.corrcoef(x[both, i], x[both, j])[0, 1]
    return out


def test_moments_merge_to_those_of_all_rows():
    x = holey(5)
    x[3, 1], x[9, 2] = INF, -INF
    parts = [comoments.batch_moments(p) for p in (x[:7], x[7:8], x[8:200], x[200:])]
    total = parts[0]
    for p in parts[1:]:
        total = comoments.merged(total, p, (total[1].T, p[1].T))
    np.testing.assert_allclose(comoments.correlations(total), plain_r(x), atol=1e-9)
    np.testing.assert_allclose(total[0], comoments.batch_moments(x)[0])


def test_300_columns(spark):
    x = holey(300, 60)
    x[:, 7], x[5, 9] = 3.0, INF
    rows = [[None if math.isnan(v) else v for v in r] for r in x.tolist()]
    df = spark.createDataFrame(rows, ", ".join(f"`c.{i}` double" for i in range(300))).repartition(5)
    got = profile.correlation_matrix(df, df.columns, digits=None).collect()
    r = np.full((300, 300), np.nan)
    for g in got:
        r[int(g["col_a"][2:]), int(g["col_b"][2:])] = np.nan if g["r"] is None else g["r"]
    np.testing.assert_allclose(r, plain_r(x), atol=1e-9)
    assert np.isnan(r[7]).all() and not np.isnan(r[9]).all()  # a constant has no r; one infinity voids no pair


def test_infinities_count_as_missing_in_few_columns_too(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (INF, 5.0), (3.0, 7.0), (NAN, 1.0)], "a double, b double")
    got = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b"]).collect()}
    assert got["a", "b"] == round(float(np.corrcoef([1, 2, 3], [2, 4, 7])[0, 1]), 6) and got["a", "a"] == 1.0
    assert comoments.wide_correlation_matrix(df.limit(0), ["a"]).collect()[0]["r"] is None


def test_binned_density_stays_within_its_bound(spark):
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.normal(0, 1, 1500), rng.normal(30, 0.2, 500), rng.exponential(9, 1000)])
    df = spark.createDataFrame([(float(v),) for v in x] + [(INF,), (NAN,), (None,)], "`x.y` double")
    h = x.std(ddof=1) * len(x) ** -0.2
    for cells in (64, 512, 4096):
        got = profile.binned_density(df, "x.y", 60, cells, digits=None).collect()
        bound = profile.binned_density_error(h, (x.max() - x.min()) / (cells - 1))
        for r in got:
            exact = np.exp(-0.5 * ((r["x"] - x) / h) ** 2).sum() / (len(x) * h * math.sqrt(2 * math.pi))
            assert abs(r["density"] - exact) <= bound * (1 + 1e-6) + 1e-12
    assert bound < 2e-6 and len(got) == 60
    assert profile.binned_density(df.where("`x.y` is null"), "x.y").collect() == []


def counted(df, seen):
    """``df`` through a step that counts the rows that pass it."""

    def step(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(step, df.schema)


def test_profile_takes_two_scans_and_equals_the_single_functions(spark):
    df = spark.createDataFrame(
        [(i % 7, None if i % 5 == 0 else float(i % 11), "" if i % 3 == 0 else "t") for i in range(500)] + [(1, INF, "u"), (1, -INF, None), (2, NAN, "v")],
        "a int, bc double, t string",
    ).coalesce(2)
    seen = spark.sparkContext.accumulator(0)
    p = profile.combined_profile(counted(df, seen), ["a", "bc"], "bc", bins=5)
    for x in p.values():
        x.collect()
    assert seen.value == 2 * df.count()
    same = lambda a, b: sorted(map(tuple, a.collect()), key=str) == sorted(map(tuple, b.collect()), key=str)
    assert same(p["counts"], profile.profile_counts(df)) and same(p["missing"], profile.profile_missing(df))
    assert same(p["correlations"], profile.correlation_matrix(df, ["a", "bc"]))
    assert same(p["histogram"], profile.histogram(df, "bc", 5))
    assert same(p["density"], profile.binned_density(df, "bc"))
    empty = profile.combined_profile(df.limit(0), ["a"], "bc")
    assert empty["counts"].first()["n_rows"] == 0 and empty["histogram"].collect() == [] == empty["density"].collect()
    one = profile.combined_profile(df.where("a = 1 and bc = 3"), [], "bc")
    assert one["correlations"] is None and sum(r["n"] for r in one["histogram"].collect()) > 0 and one["density"].collect() == []


def test_sketches_merge_within_the_rank_error(spark):
    rng = np.random.default_rng(6)
    values = rng.exponential(3, 60_000)
    df = spark.createDataFrame([("m", i % 40, float(v)) for i, v in enumerate(values)] + [("m", 1, NAN), ("n", 2, None)], "market string, day int, `x.y` double")
    stored = sketches.quantile_sketches(df, ["market", "day"], ["x.y"], k=256)
    merged = sketches.merged_quantiles(stored, ["market"], ["x.y"], [0.01, 0.25, 0.5, 0.9, 0.999]).collect()
    ordered = np.sort(values)
    for r in merged:
        if r["market"] == "n":
            assert r["n"] == 0 and r["value"] is None
            continue
        assert r["n"] == len(values)
        assert abs(np.searchsorted(ordered, r["value"]) / len(values) - r["q"]) <= 0.01
    exact = quantiles.exact_quantiles(df.where("market = 'm'"), ["x.y"], 0.5)["x.y"]
    half = next(r["value"] for r in merged if r["market"] == "m" and r["q"] == 0.5)
    assert abs(np.searchsorted(ordered, exact) - np.searchsorted(ordered, half)) <= 0.01 * len(values)


def test_csv_lines_are_good_or_quarantined(spark, tmp_dir):
    path = os.path.join(tmp_dir, "x.csv")
    open(path, "w").write('id,a.b,t\n1,2.5,x\n2,oops,y\n3,1\n4,1,z,more\n\n5,,"q,q"\nsix,1,w\n')
    schema = T.StructType.fromDDL("id int, `a.b` double, t string")
    tagged = read_csv_tagged(spark, path, schema)
    good = tagged.where("status = 'ok'").drop("status", "raw").collect()
    assert sorted(map(tuple, good)) == [(1, 2.5, "x"), (5, None, "q,q")]
    bad = tagged.where("status = 'quarantine'").select("raw", "id", "t").collect()
    assert sorted(r["raw"] for r in bad) == ["2,oops,y", "3,1", "4,1,z,more", "six,1,w"] and {r["id"] for r in bad} == {None}
    # whatever columns are asked for
    assert {r["status"]: r["count"] for r in tagged.groupBy("status").count().collect()} == {"ok": 2, "quarantine": 4}
    with pytest.raises(ValueError):
        read_csv_tagged(spark, path, T.StructType.fromDDL("_corrupt_record string"))


def test_upload_with_bad_lines_is_scored_and_the_rest_kept(spark, tmp_dir):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    csv, model, bad = (os.path.join(tmp_dir, x) for x in ("raw", "model", "bad"))
    write_csv(raw, csv)
    jobs.prepare(spark, csv, os.path.join(tmp_dir, "prepared"), csv_schema=raw.schema)
    jobs.train(spark, os.path.join(tmp_dir, "prepared"), model, allow_leak=True, num_trees=2)
    with open(os.path.join(csv, "part-99999.csv"), "w") as f:
        f.write(",".join(raw.columns) + "\nbroken line\n1,2\n")
    scored = jobs.score_csv(spark, csv, model, csv_schema=raw.schema, quarantine_path=bad)
    assert scored.count() == raw.count()
    assert sorted(r["raw"] for r in spark.read.parquet(bad).collect()) == ["1,2", "broken line"]
    assert ml.load_model(model) is not None and scored.where(F.col("prob_class_1").isNull()).count() == 0
    with pytest.raises(ValueError):
        jobs.score_csv(spark, csv, model, quarantine_path=bad)
