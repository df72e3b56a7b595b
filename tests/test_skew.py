"""A key holding a third of all rows: results stay whole and exact; AQE splits it."""

from collections import Counter

from pyspark.sql import functions as F

from shiplens.operators import rollup


def test_hot_region_join_and_rollup(spark):
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        n = 30_000
        df = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise(F.concat(F.lit("r"), (F.col("id") % 50).cast("string")))
            .alias("order_region"),
            (F.col("id") % 1000 / 10).alias("sales"),
            (F.col("id") % 17).cast("int").alias("delivery_days"),
        ).repartition(16)
        stats = rollup.region_stats(df)
        # small per-task target so the fixture has a hot key: 10,000 rows of
        # HOT are cut into ceil(10000 / 500) = 20 pieces, no cap
        joined = rollup.join_group_stats(df, stats, "order_region", count_col="region_order_count",
                                         target_rows=500)
        hot = {r["order_region"]: r["__s"]
               for r in rollup.hot_keys(stats, "order_region", "region_order_count", target_rows=500).collect()}
        assert hot == {"HOT": 20}  # only the hot key is split, by its size
        rows = joined.select("order_region", "region_order_count").collect()
        assert len(rows) == n  # nothing dropped
        expect = Counter("HOT" if i % 3 == 0 else f"r{i % 50}" for i in range(n))
        assert all(r["region_order_count"] == expect[r["order_region"]] for r in rows)
        summary = {r["market"]: r["n_orders"] for r in rollup.market_summary(df.withColumnRenamed("order_region", "market")).collect()}
        assert summary == dict(expect)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_aqe_splits_hot_key_in_shuffled_join(spark):
    """The fixture's fact-to-dimension joins rely on AQE skew handling."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        big = spark.range(60_000).select(
            F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id") % 5000).alias("k"), F.col("id").alias("v")
        )
        dim = spark.range(5000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        j = big.join(dim, "k")
        assert len(j.collect()) == 60_000
        plan = j._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salt_count_is_uncapped_and_hot_list_bounded():
    per = rollup.rows_per_task
    assert per(30_000, target_rows=500) == 500
    # a huge table raises rows per task so fewer than max_hot_keys keys are hot
    assert per(600_000_000_000) == 6_000_000
    # a key with a third of 600 billion rows gets 33,334 salts, not a capped few
    assert -(-200_000_000_000 // per(600_000_000_000)) == 33_334


def test_small_side_hints_only_bounded_inputs(spark):
    from shiplens.operators.joins import small_side

    def hinted(df):
        return "BROADCAST" in df._jdf.queryExecution().logical().toString().upper()

    assert hinted(small_side(spark.range(3), max_rows=5))
    assert not hinted(small_side(spark.range(10), max_rows=5))


def broadcast_subtrees(plan: str) -> list[str]:
    """Text of every subtree under a BroadcastExchange node of a plan tree string."""
    lines = plan.splitlines()
    out = []
    for i, line in enumerate(lines):
        pos = line.find("BroadcastExchange")
        if pos < 0:
            continue
        sub = [line]
        for nxt in lines[i + 1:]:
            body = len(nxt) - len(nxt.lstrip(" :+-"))
            if body <= pos:
                break
            sub.append(nxt)
        out.append("\n".join(sub))
    return out


def test_star_join_never_broadcasts_the_fact_table(spark):
    """Only the size-checked geography dimension is broadcast before run time."""
    from shiplens import fixtures

    df = fixtures.shipments(spark, "/root/testdata/sf0.01")
    # the initial plan holds the static decisions (AQE re-plans later from
    # measured sizes): dimension broadcasts only
    initial = df._jdf.queryExecution().executedPlan().toString()
    subtrees = broadcast_subtrees(initial)
    assert subtrees, "the nation/region dimension should be broadcast"
    for sub in subtrees:
        assert "lineitem.parquet" not in sub and "orders.parquet" not in sub and "customer.parquet" not in sub
    assert df.count() == 60_000


def test_cluster_conf_sizes_shuffles_for_the_input():
    from shiplens.session import cluster_conf

    small = cluster_conf(10 << 30)  # 10 GiB: the floor of 200 partitions
    assert small["spark.sql.shuffle.partitions"] == "200"
    big = cluster_conf(100 << 40)  # 100 TiB at 128 MiB per partition
    assert big["spark.sql.shuffle.partitions"] == "819200"
    assert big["spark.sql.adaptive.coalescePartitions.parallelismFirst"] == "false"
    assert big["spark.sql.files.maxPartitionBytes"] == str(128 << 20)
