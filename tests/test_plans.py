"""Plan properties the design relies on: pushdown, pruning, no Python UDFs."""

import os

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from shiplens import fixtures
from shiplens.operators import rollup
from shiplens.plans.catalog import QUERIES
from shiplens.sinks.files import write_parquet
from tests.conftest import SF_SMALL


def plan_text(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_time_filter_reaches_the_parquet_scan(spark, tmp_dir):
    path = os.path.join(tmp_dir, "history")
    write_parquet(fixtures.agg_history(spark, SF_SMALL), path)
    picked = rollup.filter_time_range(spark.read.parquet(path), "2024-01-05", "2024-01-10")
    plan = plan_text(picked)
    pushed = plan[plan.index("PushedFilters"):].split("]")[0]
    assert "GreaterThanOrEqual(ts" in pushed and "LessThan(ts" in pushed


def test_day_predicate_prunes_partitions(spark, tmp_dir):
    path = os.path.join(tmp_dir, "by-day")
    hist = fixtures.agg_history(spark, SF_SMALL).withColumn("day", F.to_date("ts"))
    write_parquet(hist, path, partition_by=["day"])
    stored = spark.read.parquet(path).where(F.col("day") >= F.lit("2024-01-05"))
    plan = plan_text(stored)
    filters = plan[plan.index("PartitionFilters"):].split("]")[0]
    assert "day" in filters


def test_flagship_reads_only_the_columns_it_needs(spark):
    plan = plan_text(E.queries()["market_summary"](spark, SF_SMALL))
    li = [seg for seg in plan.split("FileScan")[1:] if "lineitem.parquet" in seg][0]
    schema = li[li.index("ReadSchema"):].split("\n")[0]
    assert "l_comment" not in schema and "l_shipmode" not in schema
    assert "l_orderkey" in schema and "l_extendedprice" in schema


# queries that only build a plan; those that run jobs or train a model are covered by the parity test
EAGER = ("stream", "job_", "model", "score_", "confusion")
BATCH_QUERIES = sorted(n for n in QUERIES if not any(x in n for x in EAGER))


@pytest.mark.parametrize("name", BATCH_QUERIES)
def test_no_python_udf_in_query_plan(spark, name):
    plan = plan_text(E.queries()[name](spark, SF_SMALL))
    for node in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert node not in plan, f"{name} runs Python per row: {node}"


def test_registered_queries_apply_the_broadcast_policy(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10485760")  # as a default session has
    try:
        E.queries()["market_summary"](spark, SF_SMALL)
        assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == "-1"
        assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
