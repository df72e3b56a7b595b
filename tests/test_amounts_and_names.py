"""Amounts that fixed point can't hold, and column names that need quoting."""

import math
import os

import pytest
from pyspark.sql import functions as F

from shiplens import fixtures
from shiplens.functions.numeric import money_mean, money_sum
from shiplens.operators import clean, features, model as ml, rollup, schema
from shiplens.plans import jobs
from shiplens.sinks.files import write_csv
from shiplens.streaming.windows import windowed_stats
from tests.conftest import SF_SMALL

INF, NAN = float("inf"), float("nan")


@pytest.mark.parametrize(
    "values,total",
    [
        ([1.0, NAN, 3.0], NAN),
        ([1.0, INF], INF),
        ([-INF, 2.0, None], -INF),
        ([INF, -INF], NAN),
        ([1e18, 1.0], 1e18 + 1),
        ([2.0**70, -(2.0**70), 0.25], 0.25),
        ([1e17, 0.5, None], 1e17 + 0.5),
        ([0.1, 0.2, 0.3], 0.6),
        ([None, None], None),
        ([], None),
    ],
)
def test_one_rule_for_all_sums(spark, values, total):
    df = spark.createDataFrame([("k", v, 3) for v in values], "market string, sales double, delivery_days int")
    n = sum(v is not None for v in values)
    same = lambda a, b: a == b or (a is not None and b is not None and math.isnan(a) and math.isnan(b))
    got = df.agg(money_sum("sales").alias("s"), money_mean("sales").alias("m")).first()
    assert same(got["s"], total) and same(got["m"], None if total is None else total / n)
    if not values:
        return
    assert same(rollup.market_summary(df).first()["sum_sales"], total)
    stats = rollup.region_stats(df, key="market").first()
    assert same(stats["region_avg_sales"], None if total is None else total / n) and stats["region_order_count"] == len(values)
    again = rollup.rollup_of_rollups(rollup.market_summary(df)).first()
    assert same(again["sum_sales"], total)


def test_window_means_do_not_depend_on_the_order(spark):
    rows = [(f"2024-01-01 00:00:{i % 60:02d}", "m", (i * 7919 % 10007) / 100 + 1e6, 1) for i in range(5000)]
    df = spark.createDataFrame(rows, "t string, market string, sales double, delivery_days int")
    df = df.withColumn("ts", F.col("t").cast("timestamp"))
    means = {windowed_stats(df.repartition(n, "sales"), "ts", watermark=None).first()["avg_sales"] for n in (1, 3, 7, 16)}
    assert len(means) == 1


NAMES = "`a.b` double, `it's` string, `c``d` int, market string, `s.t` struct<`x.y`: int, z: int>"


def odd_rows(spark):
    rows = [(None, None, 1, "m", (1, 2)), (NAN, "t", None, None, (3, 4)), (2.5, "u", 7, "n", None)]
    return spark.createDataFrame(rows, NAMES)


def test_operators_take_any_column_name(spark):
    df = odd_rows(spark)
    filled = clean.impute_constant(df, ["a.b", "it's", "c`d"]).collect()
    assert [(r["a.b"], r["it's"], r["c`d"]) for r in filled] == [(0.0, "unknown", 1), (0.0, "t", 0), (2.5, "u", 7)]
    for exact in (True, False):
        median = clean.impute_median(df, ["a.b", "c`d"], exact=exact).collect()
        assert [r["a.b"] for r in median] == [2.5, 2.5, 2.5] and median[1]["c`d"] == 1
    assert schema.select_present(df, ["c`d", "no", "a.b"]).columns == ["c`d", "a.b"]
    assert schema.cast_columns(df, {"c`d": "string", "it's": "double"}, lenient=True).first()["c`d"] == "1"
    flat = schema.flatten_struct(df, "s.t")
    assert flat.columns[-2:] == ["x.y", "z"] and flat.first()["x.y"] == 1
    assert [r["c`d"] for r in clean.drop_nulls(df, ["a.b"]).collect()] == [7]
    assert df.select(schema.surrogate_key(["a.b", "it's", "c`d"]).alias("k")).distinct().count() == 3
    assert features.sample_hash(df, ["a.b", "c`d"], 1.0).count() == 3
    assert features.split_hash(df, ["it's"]).count() == 3


def test_names_are_lower_case_not_folded(spark):
    assert schema.normalize_name(" Straße (Nord) ") == "straße_nord"
    assert schema.normalize_columns(spark.createDataFrame([(1, 2)], "`Straße` int, `Strasse` int")).columns == ["straße", "strasse"]


def test_upload_with_odd_headers_is_scored(spark, tmp_dir):
    raw = fixtures.raw_orders(spark, SF_SMALL)
    prepared = jobs.prepare(spark, _csv(raw, tmp_dir, "raw"), os.path.join(tmp_dir, "prepared"), csv_schema=raw.schema)
    jobs.train(spark, os.path.join(tmp_dir, "prepared"), os.path.join(tmp_dir, "model"), allow_leak=True, num_trees=3)
    odd = raw.withColumns({"note v1.0": F.lit("x"), "it's": F.lit(None).cast("double"), "back`tick": F.lit(3)})
    scored = jobs.score_csv(spark, _csv(odd, tmp_dir, "odd"), os.path.join(tmp_dir, "model"), csv_schema=odd.schema)
    assert {"note_v1.0", "it's", "back`tick"} <= set(scored.columns)
    assert scored.count() == prepared.count()
    got = scored.groupBy("`note_v1.0`", "`it's`", "`back``tick`").count().collect()
    assert [tuple(r) for r in got] == [("x", None, 3, prepared.count())]
    kept = ml.score(ml.load_model(os.path.join(tmp_dir, "model")), prepared.withColumn("p.q", F.lit(1)), keep=["p.q", "market"])
    assert kept.columns == ["p.q", "market", "prediction", "prob_class_1"] and kept.count() == prepared.count()


def _csv(df, tmp_dir, name):
    path = os.path.join(tmp_dir, name)
    write_csv(df, path)
    return path
