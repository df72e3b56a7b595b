"""Values and keys the driver's tables don't hold: infinities, wide integers, odd names, skewed keys."""

import math
import os
import random
from collections import Counter
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from shiplens.operators import lateness, profile, quantiles, rollup
from shiplens.streaming import windows
from tests.conftest import SF_SMALL
from tests.test_skew import broadcast_subtrees

INF = float("inf")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "kind,values",
    [
        ("bigint", [2**60 + 3, 2**60 + 1, 2**60 + 2, -(2**62), 2**62, None]),
        ("bigint", [-(2**63), 2**63 - 1, 0]),
        ("double", [1.0, INF, 2.0, -INF, float("nan"), None, 3.0, INF]),
        ("double", [INF, INF, INF]),
        ("double", [5e-324, 0.0, -5e-324, 1e308, -1e308, 1e-308]),
        ("decimal(38,10)", [Decimal("12345678901234567890.0000000001"), Decimal("12345678901234567890.0000000002"), Decimal("0")]),
        ("int", []),
    ],
)
def test_exact_quantiles_keep_type_and_order_infinities(spark, kind, values):
    df = spark.createDataFrame([(v,) for v in values], f"`it's.x` {kind}")
    there = sorted(v for v in values if v is not None and v == v)
    for q in (0.01, 0.34, 0.5, 0.67, 1.0):
        want = there[max(1, math.ceil(q * len(there))) - 1] if there else None
        assert quantiles.exact_quantiles(df, ["it's.x"], q, bins=4)["it's.x"] == want


def test_profiles_accept_any_column_name(spark):
    df = spark.createDataFrame([(1.0, None, 1), (2.0, "a", 2)], "`it's` double, `a.b` string, `c``d` int")
    got = {r["column_name"]: r["n_missing"] for r in profile.profile_missing(df).collect()}
    assert got == {"it's": 0, "a.b": 1, "c`d": 0}
    pairs = {(r["col_a"], r["col_b"]): r["r"] for r in profile.correlation_matrix(df, ["it's", "c`d"]).collect()}
    assert pairs[("it's", "c`d")] == 1.0


def test_histogram_and_density_with_infinities(spark):
    values = [0.0, 1.0, 2.0, 9.0, 10.0, INF, -INF, -INF, float("nan"), None]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    h = profile.histogram(df, "x", 5).collect()
    assert [r["n"] for r in h] == [4, 1, 0, 0, 3]  # the ends take the infinite values
    assert (h[0]["bin_lo"], h[-1]["bin_hi"]) == (0.0, 10.0)
    d = profile.density_curve(df, "x", 20).collect()
    assert len(d) == 20 and all(math.isfinite(r["density"]) and r["density"] > 0 for r in d)
    assert profile.histogram(df.where("x = 0"), "x", 3).collect()[0]["n"] == 1


def test_density_equals_the_plain_sum(spark):
    rnd = random.Random(3)
    xs = [float(rnd.randint(0, 40)) for _ in range(500)]
    df = spark.createDataFrame([(x,) for x in xs], "x double").repartition(3)
    got = profile.density_curve(df, "x", 11).collect()
    mean = sum(xs) / len(xs)
    h = math.sqrt(sum((x - mean) ** 2 for x in xs) / (len(xs) - 1)) * len(xs) ** -0.2
    for r in got:
        want = sum(math.exp(-0.5 * ((r["x"] - x) / h) ** 2) for x in xs) / (len(xs) * h * math.sqrt(2 * math.pi))
        assert r["density"] == pytest.approx(want, abs=1e-9)


def test_small_statistics_are_broadcast_and_the_fact_is_not_shuffled(spark):
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), F.col("id"))
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = rollup.join_group_stats(df, stats, "k", count_col="n")
    plan = plan_of(out)
    assert broadcast_subtrees(plan) and "hashpartitioning" not in plan
    assert out.where("n is null").count() == 0


@pytest.fixture()
def no_broadcast(spark, monkeypatch):
    """Statistics count as large, so that the salted path runs."""
    monkeypatch.setattr(rollup, "is_small", lambda df: False)
    old = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", old)


def test_null_keys_stay_out_of_the_shuffle_and_copies_are_split(spark, no_broadcast):
    n = 9000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None).cast("string")).when(F.col("id") % 3 == 1, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string")).alias("k"),
        F.lit("same").alias("v"),  # all rows of HOT are copies of one row
    ).repartition(12)
    stats = df.groupBy("k").agg(F.count(F.lit(1)).alias("n"))
    out = rollup.join_group_stats(df, stats, "k", count_col="n", target_rows=300)
    rows = out.groupBy("k").agg(F.count(F.lit(1)).alias("rows"), F.min("n").alias("n")).collect()
    counts = Counter(r["k"] for r in df.collect())
    assert {r["k"]: r["rows"] for r in rows} == counts
    assert all(r["n"] == (None if r["k"] is None else counts[r["k"]]) for r in rows)
    # no task of the join may hold all copies of the hot row
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert "isnotnull(k" in text and "SPARK_PARTITION_ID" in text
    sizes = Counter(
        r["s"] for r in df.where("k = 'HOT'").select(F.pmod(F.xxhash64("k", "v", F.spark_partition_id()), F.lit(10)).alias("s")).collect()
    )
    assert len(sizes) > 3 and max(sizes.values()) < 0.5 * sum(sizes.values())


def test_late_events_with_outlying_and_missing_arrivals(spark):
    rnd = random.Random(9)
    rows = [(i, rnd.randint(0, 5000)) for i in range(1, 400)] + [(10**15, 100), (None, 7), (None, 10**6)]
    df = spark.createDataFrame(rows, "arrival long, t long").withColumn("ts", F.timestamp_seconds("t"))
    out = lateness.late_events(df, "arrival", "ts", delay_seconds=30, rows_per_range=20)
    got = Counter((r["arrival"], r["t"], r["is_late"]) for r in out.collect())
    want = Counter()
    for a, t in rows:
        prior = [u for b, u in rows if a is not None and b is not None and b < a]
        want[(a, t, bool(prior) and t < max(prior) - 30)] += 1
    assert got == want
    ranged = df.where("arrival is not null").repartitionByRange(20, "arrival").withColumn("b", F.spark_partition_id())
    assert ranged.groupBy("b").count().agg(F.max("count")).first()[0] < 60  # an outlier doesn't crowd a range


def test_one_wrong_timestamp_makes_rows_not_a_failure(spark):
    rows = [("a", "2024-01-01 00:10:00", 3), ("a", "2031-01-01 05:00:00", 4), ("b", "2024-01-01 00:59:00", 1), (None, "2024-01-01 00:00:00", 2), ("b", None, 9)]
    df = spark.createDataFrame(rows, "m string, ts string, n_orders int").withColumn("ts", F.to_timestamp("ts"))
    out = rollup.resample_hourly(df, by=["m"])
    per = {r["m"]: (r["count"], r["total"]) for r in out.groupBy("m").agg(F.count(F.lit(1)).alias("count"), F.sum("n_orders").alias("total")).collect()}
    assert per["b"] == (1, 1) and per[None] == (1, 2) and per["a"][1] == 7
    assert per["a"][0] == (2557 * 24) + 6


def test_update_mode_returns_the_latest_row_of_every_window(spark, tmp_dir):
    ev = spark.read.parquet(os.path.join(SF_SMALL, "events.parquet"))
    src = os.path.join(tmp_dir, "src")
    for i in range(3):
        ev.where(F.col("event_id") % 3 == i).coalesce(1).write.mode("append").parquet(src)
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src).withColumn("ts", F.col("ts").cast("timestamp"))
    options = {"key": "event_type", "window": "1 hour", "watermark": "100 days", "days_col": None, "sales_col": "value"}
    keys = ["event_type", "window_start", "window_end"]
    out, ck = os.path.join(tmp_dir, "out"), os.path.join(tmp_dir, "ck")
    got = windows.run_available(windows.windowed_stats(stream, "ts", **options), out, ck, mode="update", keys=keys)
    whole = windows.windowed_stats(ev.withColumn("ts", F.col("ts").cast("timestamp")), "ts", **options | {"watermark": None})
    count = lambda df: sorted((r["event_type"], str(r["window_start"]), r["n_events"]) for r in df.collect())
    assert count(got) == count(whole)
    with pytest.raises(ValueError):
        windows.run_available(stream, out, ck, mode="update")
    with pytest.raises(ValueError):
        windows.run_available(stream, out, ck, mode="upsert")
