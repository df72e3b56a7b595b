"""The forest as native columns and SQL, and the exact AUC."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from shiplens.operators import features, forest, model as ml, prefix, ranking
from shiplens.plans import catalog
from shiplens.plans.catalog import model_table, trained_model
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("case_nodes", [0, 10**6])
def test_native_columns_equal_the_pipeline(spark, tmp_dir, case_nodes):
    table = model_table(spark, SF_SMALL)
    res = ml.train_late_model(table, allow_leak=True, num_trees=4, max_depth=4)
    path = os.path.join(tmp_dir, "m")
    ml.save_model(res.model, path)
    nodes = forest.node_table(spark, path, res.model)
    assert nodes.select("tree").distinct().count() == 4 and nodes.where("not is_leaf and input is null").count() == 0
    # empty and unseen inputs too
    odd = table.withColumns({
        "order_region": F.when(F.col("line_number") == 1, "Nowhere").otherwise(F.col("order_region")),
        "sales": F.when(F.col("line_number") == 2, None).otherwise(F.col("sales")),
        "shipping_mode": F.when(F.col("line_number") == 3, None).otherwise(F.col("shipping_mode")),
    })
    want = ml.score(res.model, odd, keep=["order_id", "line_number"]).collect()
    rows = ml.fill_inputs(res.model, odd)
    got = rows.withColumn("p", forest.probability(rows, nodes, case_nodes)).select("order_id", "line_number", "p").collect()
    want = sorted((r["order_id"], r["line_number"], r["prob_class_1"]) for r in want)
    got = sorted(map(tuple, got))
    assert len(want) == len(got) == table.count()
    assert all(w[:2] == g[:2] and abs(w[2] - g[2]) < 1e-12 for w, g in zip(want, got))


def test_query_scores_natively_with_every_tree(spark):
    model, _, _ = trained_model(spark, SF_SMALL)
    got = catalog.q_score_natively(spark, SF_SMALL)
    want = catalog.scores(ml.score(model, model_table(spark, SF_SMALL)))
    assert got.columns == [c for c in want.columns if c in got.columns] and set(got.columns) == set(want.columns)
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_columns_per_tree_equal_the_pipeline(spark, tmp_dir):
    # spaces in names, quotes and backslashes in categories; empty, unseen and NaN inputs when scoring
    train = spark.range(0, 600, 1, 2).selectExpr(
        "id", "cast(id * 7 % 31 as double) as `a b`", "cast(id % 11 as int) as n",
        r"""element_at(array("it's", r"back\slash", 'ünder', 'plain'), cast(id % 4 as int) + 1) as `kind of`""",
        f"cast(id * 7 % 31 + id % 11 + id % 4 > 20 as int) as {features.LABEL}", "if(id % 5 = 0, 'test', 'train') as split")
    res = ml.train_late_model(train, features=["a b", "n", "kind of"], num_trees=30)
    path = os.path.join(tmp_dir, "m")
    ml.save_model(res.model, path)
    odd = train.withColumns({
        "a b": F.when(F.col("id") % 7 == 0, float("nan")).when(F.col("id") % 7 == 1, float("-inf")).otherwise(F.col("`a b`")),
        "n": F.when(F.col("id") % 9 == 0, None).otherwise(F.col("n")),
        "kind of": F.when(F.col("id") % 13 == 0, None).when(F.col("id") % 13 == 1, "new").otherwise(F.col("`kind of`")),
    })
    forest_columns = forest.votes(forest.node_table(spark, path, res.model))
    assert len(forest_columns.trees) == 30 and len(forest_columns.tests) > 10
    scored = forest.scored_by(ml.fill_inputs(res.model, odd), forest_columns)
    assert scored.columns == [*odd.columns, "prob_class_1", "prediction"]
    want = {r["id"]: (r["prob_class_1"], r["prediction"]) for r in ml.score(res.model, odd, keep=["id"]).collect()}
    got = {r["id"]: (r["prob_class_1"], r["prediction"]) for r in scored.select("id", "prob_class_1", "prediction").collect()}
    assert len(got) == 600 and got.keys() == want.keys() and len(set(got.values())) > 20
    for k, (p, predicted) in want.items():
        assert abs(got[k][0] - p) < 1e-12 and (abs(p - 0.5) < 1e-9 or got[k][1] == predicted)
    # a caller may keep one of the results only
    assert {r["id"]: r["p"] for r in scored.selectExpr("id", "prob_class_1 as p").collect()} == {k: v[0] for k, v in got.items()}


def test_sql_over_stored_nodes_equals_native_columns(spark, tmp_dir):
    model, _, path = trained_model(spark, SF_SMALL)
    nodes = forest.node_table(spark, path, model)
    rows = forest.scored_natively(ml.fill_inputs(model, model_table(spark, SF_SMALL)), nodes)
    nodes.coalesce(1).write.parquet(f"{tmp_dir}/nodes")
    rows.coalesce(1).write.parquet(f"{tmp_dir}/rows")
    sql = forest.scoring_sql(
        f"SELECT * EXCLUDE (prob_class_1, prediction), prob_class_1 AS p FROM read_parquet('{tmp_dir}/rows/*.parquet')",
        f"read_parquet('{tmp_dir}/nodes/*.parquet')",
        ["order_region", "shipping_mode", "customer_segment"], ["geo_distance_km", "sales", "delivery_days", "num_orders"], ml.MAX_DEPTH,
    )
    n, off = duckdb.sql(f"WITH {sql} SELECT count(*), max(abs(p - prob_class_1)) FROM forest_scored").fetchall()[0]
    assert n == rows.count() and off < 1e-11


def plain_auc(pairs):
    pos = [s for s, y in pairs if y == 1]
    neg = [s for s, y in pairs if y == 0]
    return sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))


def test_rank_sum_equals_all_pairs_over_any_ranges(spark):
    pairs = [((i * 37) % 23 / 7 - 1, (i * i) % 3 % 2) for i in range(400)] + [(0.5, 1)] * 300
    rows = [(s, y) for s, y in pairs] + [(None, 1), (0.1, None), (0.2, 7)]
    df = spark.createDataFrame(rows, "`a.score` double, y int")
    for per_range in (3, 1000):
        r = ranking.rank_sum(df, "y", "a.score", rows_per_range=per_range)
        assert r.positives + r.negatives == len(pairs) and abs(r.auc - plain_auc(pairs)) < 1e-12
    one = ranking.rank_sum(df.where("y = 1"), "y", "a.score")
    assert one.negatives == 0 and one.auc != one.auc
    empty = ranking.rank_sum(df.limit(0), "y", "a.score")
    assert (empty.positives, empty.negatives) == (0, 0)


def test_rank_sum_orders_nan_and_infinity_last(spark):
    df = spark.createDataFrame([(float("nan"), 1), (float("inf"), 0), (-float("inf"), 0), (1.0, 1)], "s double, y int")
    assert ranking.rank_sum(df, "y", "s").auc == 0.75


def test_sums_before_many_ranges(spark):
    df = spark.createDataFrame([(i * i, i) for i in range(200)], "k long, v long")
    out, _ = prefix.sums_before(df, "k", ["v"], rows_per_range=7)
    assert {r["k"]: r["v_before"] for r in out.collect()} == {i * i: i * (i - 1) // 2 for i in range(200)}
