"""Unit tests for plan-time and edge-case behaviour of the operators."""

import math
import random

import pytest
from pyspark.sql import functions as F

from shiplens.functions.dates import parse_timestamp
from shiplens.functions.numeric import coerce_double, haversine_km, late_flag
from shiplens.operators import clean, features, lateness, profile, quantiles, rollup, schema


def test_normalize_columns_and_collision(spark):
    df = spark.createDataFrame([(1, 2)], "`Days for shipping (real)` int, ` Order Region ` int")
    out = schema.normalize_columns(df)
    assert out.columns == ["days_for_shipping_real", "order_region"]
    # idempotent
    assert schema.normalize_columns(out).columns == out.columns
    clash = spark.createDataFrame([(1, 2)], "`Sales` int, `sales` int")
    with pytest.raises(ValueError):
        schema.normalize_columns(clash)


def test_select_present_keeps_order_and_dedupes(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert schema.select_present(df, ["c", "x", "a", "c"]).columns == ["c", "a"]


def test_resolve_and_ensure(spark):
    df = spark.createDataFrame([(1,)], "order_region int")
    assert schema.resolve(df, ["market", "order_region"]) == "order_region"
    assert schema.resolve(df, ["market"]) is None
    out = schema.ensure_column(df, "order_region", F.lit(9))
    assert out.first()[0] == 1
    out = schema.ensure_columns(df, {"geo_distance_km": F.lit(0.0), "order_region": F.lit(7)})
    assert out.columns == ["order_region", "geo_distance_km"]


def test_surrogate_key_is_stable_under_repartition(spark):
    df = spark.range(200).select(F.col("id").cast("string").alias("a"), (F.col("id") % 3).alias("b"))
    k1 = {tuple(r) for r in df.select("a", schema.surrogate_key(["a", "b"])).collect()}
    k2 = {tuple(r) for r in df.repartition(7).select("a", schema.surrogate_key(["a", "b"])).collect()}
    assert k1 == k2 and len({k for _, k in k1}) == 200


def test_row_keys_are_unique_and_the_same_on_every_run(spark):
    rows = [("a", "b"), ("a", "b"), ("a:b", ""), ("a", ":b"), (None, "a"), ("", "a"), ("a", None), ("1:a", ""), ("", "1:a")]
    df = spark.createDataFrame(rows, "x string, y string")
    keyed = schema.with_row_key(df, "id")
    ids = [r["id"] for r in keyed.collect()]
    assert keyed.columns == ["id", "x", "y"] and len(set(ids)) == len(rows)
    assert sorted(ids) == sorted(r["id"] for r in schema.with_row_key(df.repartition(5), "id").collect())
    hot = spark.range(1000).select(F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).alias("a.b"))
    cut = schema.with_row_key(hot, "id", copies_per_task=50)
    assert cut.select("id").distinct().count() == 1000
    assert sorted(r["a.b"] or -1 for r in cut.collect()) == sorted(r["a.b"] or -1 for r in hot.collect())


def test_parse_timestamp_layouts(spark):
    df = spark.createDataFrame([(" 1/2/2024 3:04:05 ",), ("2024-01-02 03:04:05",), ("garbage",), (None,)], "t string")
    got = [r[0] for r in df.select(F.date_format(parse_timestamp("t"), "yyyy-MM-dd HH:mm:ss")).collect()]
    assert got == ["2024-01-02 03:04:05", "2024-01-02 03:04:05", None, None]


def test_late_flag_nulls_are_not_late(spark):
    df = spark.createDataFrame([(6,), (5,), (None,)], "d int")
    assert [r[0] for r in df.select(late_flag("d")).collect()] == [1, 0, 0]


def test_haversine_known_distance_and_nulls(spark):
    df = spark.createDataFrame([(0.0, 0.0, 0.0, 1.0), (None, 0.0, 0.0, 1.0), (10.0, 10.0, 10.0, 10.0)],
                               "a double, b double, c double, d double")
    got = [r[0] for r in df.select(haversine_km("a", "b", "c", "d")).collect()]
    assert got[0] == pytest.approx(2 * math.pi * 6371 / 360, rel=1e-9)
    assert got[1] == 0.0
    assert got[2] == 0.0


def test_coerce_double(spark):
    df = spark.createDataFrame([(" 12 ",), ("1.5e3",), ("n/a",), (None,)], "t string")
    assert [r[0] for r in df.select(coerce_double("t")).collect()] == [12.0, 1500.0, None, None]


def test_impute_constant_fills_nan_and_null_keeps_blank(spark):
    df = spark.createDataFrame([(None, float("nan"), None), (3, 2.0, "  ")], "i int, d double, s string")
    rows = clean.impute_constant(df).collect()
    assert tuple(rows[0]) == (0, 0.0, "unknown")
    assert tuple(rows[1]) == (3, 2.0, "  ")


def test_impute_median_exact_and_int_truncation(spark):
    df = spark.createDataFrame([(1, 1.0), (2, 2.0), (None, None), (10, 10.0)], "i int, d double")
    out = clean.impute_median(df, exact=True).collect()
    assert tuple(out[2]) == (2, 2.0)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_exact_quantiles_match_sorting(spark, seed):
    rnd = random.Random(seed)
    vals = [rnd.choice([rnd.randint(-50, 50), 7, 7, 7]) + rnd.random() * (seed - 1) for _ in range(3000)]
    vals += [None] * 20
    df = spark.createDataFrame([(v,) for v in vals], "x double").repartition(5)
    clean_vals = sorted(v for v in vals if v is not None)
    for q in (0.1, 0.5, 0.9, 1.0):
        k = max(1, math.ceil(q * len(clean_vals)))
        assert quantiles.exact_quantiles(df, ["x"], q, bins=8)["x"] == clean_vals[k - 1]


def test_exact_quantile_hot_value(spark):
    # a third of the rows share one value
    df = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(5.0)).otherwise(F.col("id")).alias("x"))
    vals = sorted(5.0 if i % 3 == 0 else float(i) for i in range(3000))
    assert quantiles.exact_quantiles(df, ["x"], 0.5)["x"] == vals[1499]


def test_profile_missing_and_drop_sparse(spark):
    df = spark.createDataFrame([(None, " ", 1), (None, "a", 2), (1, None, 3)], "a int, b string, c int")
    prof = {r["column_name"]: (r["n_missing"], r["missing_ratio"]) for r in profile.profile_missing(df).collect()}
    assert prof["a"] == (2, pytest.approx(2 / 3))
    assert prof["b"] == (2, pytest.approx(2 / 3))
    assert prof["c"] == (0, 0.0)
    assert profile.drop_sparse_columns(df, 0.7).columns == ["a", "b", "c"]
    assert profile.drop_sparse_columns(df, 0.5).columns == ["c"]


def test_histogram_counts_cover_all_rows(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    h = profile.histogram(df, "x", 30).collect()
    assert len(h) == 30
    assert sum(r["n"] for r in h) == 1000
    assert h[-1]["bin_hi"] == pytest.approx(96.0)


def test_correlation_matrix_pairs(spark):
    df = spark.createDataFrame([(1.0, 2.0, None), (2.0, 4.0, 1.0), (3.0, 6.0, 0.0)], "a double, b double, c double")
    m = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, ["a", "b", "c"]).collect()}
    assert m[("a", "b")] == 1.0 and m[("b", "a")] == 1.0
    assert m[("a", "c")] == -1.0  # pairwise complete: only the last two rows


def test_density_integrates_to_about_one(spark):
    df = spark.range(2000).select(F.randn(7).alias("x"))
    d = profile.density_curve(df, "x", 200).collect()
    step = d[1]["x"] - d[0]["x"]
    assert sum(r["density"] for r in d) * step == pytest.approx(1.0, abs=0.05)


def test_sample_and_split_are_deterministic_disjoint_and_cover(spark):
    df = spark.range(5000).select(F.col("id").cast("string").alias("k"))
    s1 = {r[0] for r in features.sample_hash(df, ["k"], 0.1).collect()}
    s2 = {r[0] for r in features.sample_hash(df.repartition(9), ["k"], 0.1).collect()}
    assert s1 == s2 and 350 < len(s1) < 650
    split = features.split_hash(df, ["k"], 0.8)
    counts = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}
    assert counts["train"] + counts["test"] == 5000
    assert 3800 < counts["train"] < 4200


def test_resample_fills_gaps_and_keeps_total(spark):
    df = spark.createDataFrame(
        [("2024-01-01 00:10:00", 3), ("2024-01-01 03:59:00", 4), ("2024-01-01 03:01:00", 1)], "ts string, n_orders int"
    ).withColumn("ts", F.to_timestamp("ts"))
    out = rollup.resample_hourly(df).orderBy("ts").collect()
    assert [r["n_orders"] for r in out] == [3, 0, 0, 5]


def test_join_group_stats_null_key_gets_null_stats(spark):
    df = spark.createDataFrame([("a", 1.0, 1), (None, 2.0, 2), ("a", 3.0, 3)], "order_region string, sales double, delivery_days int")
    stats = rollup.region_stats(df)
    out = {(r["order_region"], r["sales"]): r["region_order_count"] for r in rollup.join_group_stats(df, stats, "order_region").collect()}
    assert out[("a", 1.0)] == 2 and out[(None, 2.0)] is None


def test_latest_n_is_top_k(spark):
    df = spark.range(100).select(F.timestamp_seconds("id").alias("ts"), F.col("id"))
    out = rollup.latest_n(df, 5).collect()
    assert [r["id"] for r in out] == [95, 96, 97, 98, 99]
    plan = rollup.latest_n(df, 5)._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject(limit=5" in plan


def test_late_events_matches_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.randint(0, 300), rnd.randint(0, 10_000)) for _ in range(2000)]
    rows += [(150, 5)] * 500  # a hot arrival key
    df = spark.createDataFrame(rows, "arrival long, t long").withColumn("ts", F.timestamp_seconds("t"))
    out = lateness.late_events(df, "arrival", "ts", delay_seconds=30, rows_per_range=16)
    got = sorted((r["arrival"], r["t"], r["is_late"]) for r in out.collect())
    expect = []
    for a, t in rows:
        prior = [tt for aa, tt in rows if aa < a]
        expect.append((a, t, bool(prior) and t < max(prior) - 30))
    assert got == sorted(expect)


def test_small_helpers(spark):
    import datetime as dt

    from shiplens.functions.dates import to_day
    from shiplens.functions.numeric import coerce_value
    from shiplens.sources.tables import as_utc_timestamps

    df = spark.createDataFrame([(1, ("a", 2)), (2, None)], "id int, s struct<x:string,y:int>")
    flat = schema.flatten_struct(df, "s", prefix="s_")
    assert flat.columns == ["id", "s_x", "s_y"]
    assert sorted(flat.collect(), key=lambda r: r["id"]) == [(1, "a", 2), (2, None, None)]

    rows = spark.createDataFrame([(3, None), (1, "b"), (2, "c")], "k int, v string")
    assert [r["k"] for r in rollup.first_n(rows, 2, ["k"]).collect()] == [1, 2]
    assert sorted(r["k"] for r in clean.drop_nulls(rows, ["v"]).collect()) == [1, 2]

    text = spark.createDataFrame([(" -12 ",), ("12.0",), ("1e3",), (" x y ",), ("",), (None,)], "t string")
    assert [tuple(r[0]) for r in text.select(coerce_value("t")).collect()] == [
        (-12, None, None), (None, 12.0, None), (None, 1000.0, None), (None, None, "x y"), (None, None, ""), (None, None, None),
    ]

    ntz = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-05 23:30:00' AS ts, 1 AS n")
    utc = as_utc_timestamps(ntz)
    assert dict(utc.dtypes)["ts"] == "timestamp" and dict(utc.dtypes)["n"] == "int"
    assert utc.select(to_day("ts")).first()[0] == dt.date(2024, 1, 5)
