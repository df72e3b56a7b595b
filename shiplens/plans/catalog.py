"""Registered queries: ``(spark, sf_dir) -> DataFrame``, one per operator.

Each query reads the driver's tables (or data Spark derives from them) in
full.  Result columns are named exactly as in :mod:`shiplens.plans.oracle_sql`;
timestamps are rendered as ``yyyy-MM-dd HH:mm:ss`` text for the comparison,
and floating results that depend on summation order are rounded.
"""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens import fixtures
from shiplens.functions.dates import parse_timestamp
from shiplens.functions.numeric import coerce_double, coerce_value, haversine_km, late_flag, money_sum
from shiplens.operators import clean, features, forest, lateness, profile, rollup, schema
from shiplens.plans import published
from shiplens.operators.model import PROBABILITY_DIGITS
from shiplens.session import remove_path, rename_folder, stage_table
from shiplens.sources import lines

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

PROFILED = ["delivery_days", "sales", "num_orders", "benefit_per_order"]


def query(name: str):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return deco


def ts_text(c: str | Column) -> Column:
    col = F.col(c) if isinstance(c, str) else c
    return F.date_format(col, "yyyy-MM-dd HH:mm:ss")


def history_text(df: DataFrame) -> DataFrame:
    """Stored aggregates with ``ts`` as text."""
    return df.select(
        ts_text("ts").alias("ts"), "market", "n_orders", "avg_delivery_days", "sum_sales", "batch_id"
    )


# ---------------------------------------------------------------- rollups
@query("market_summary")
def q_market_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.market_summary(fixtures.shipments(spark, sf_dir))


@query("resolve_group_column")
def q_resolve_group_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    # no market column: the rollup falls back to the region
    df = fixtures.shipments(spark, sf_dir).drop("market")
    key = schema.resolve(df, rollup.GROUP_ALIASES)
    return rollup.market_summary(df, out_key="group_value").select(
        F.lit(key).alias("group_by"), "*"
    )


@query("region_stats")
def q_region_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.region_stats(fixtures.shipments(spark, sf_dir))


@query("join_group_stats")
def q_join_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    stats = rollup.region_stats(df)
    # the count is null for rows without a region; carried as double so both
    # engines hand the nullable column over in the same type
    return rollup.join_group_stats(df, stats, "order_region", count_col="region_order_count").select(
        "order_key", "line_number", "order_region",
        F.col("region_order_count").cast("double").alias("region_order_count"),
        "region_avg_sales", "region_avg_delivery_days",
    )


@query("filter_time_range")
def q_filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = fixtures.agg_history(spark, sf_dir)
    return history_text(rollup.filter_time_range(hist, "2024-01-05", "2024-01-10"))


@query("filter_market")
def q_filter_market(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = fixtures.agg_history(spark, sf_dir)
    return history_text(rollup.filter_market(hist, " click "))


@query("dashboard_kpis")
def q_dashboard_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = rollup.dashboard_kpis(fixtures.agg_history(spark, sf_dir))
    return k.select(
        "total_orders",
        F.round("avg_delivery_days", 6).alias("avg_delivery_days"),
        F.round("weighted_avg_delivery_days", 6).alias("weighted_avg_delivery_days"),
        "total_sales",
    )


@query("rollup_of_rollups")
def q_rollup_of_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = rollup.rollup_of_rollups(fixtures.agg_history(spark, sf_dir))
    return r.select("market", "n_orders", F.round("avg_delivery_days", 6).alias("avg_delivery_days"), "sum_sales")


@query("resample_hourly")
def q_resample_hourly(spark: SparkSession, sf_dir: str) -> DataFrame:
    # per market, so that empty hours exist and are filled with 0
    r = rollup.resample_hourly(fixtures.agg_history(spark, sf_dir), by=["market"])
    return r.select("market", ts_text("ts").alias("ts"), "n_orders")


@query("distinct_markets")
def q_distinct_markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollup.distinct_values(fixtures.agg_history(spark, sf_dir), "market")


@query("latest_n")
def q_latest_n(spark: SparkSession, sf_dir: str) -> DataFrame:
    hist = fixtures.agg_history(spark, sf_dir)
    return history_text(rollup.latest_n(hist, 200, "ts", tie_break=["market"]))


@query("preview_rows")
def q_preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history_text(rollup.first_n(fixtures.agg_history(spark, sf_dir), 20, ["ts", "market"]))


@query("subcent_sums")
def q_subcent_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals of amounts with digits below a cent (converted prices), on every rollup."""
    s = fixtures.shipments(spark, sf_dir)
    rate = F.lit(Decimal("0.0371"))
    priced = s.withColumn("sales", (F.col("sales").cast("decimal(18,2)") * rate.cast("decimal(5,4)")).cast("double"))
    summary = rollup.market_summary(priced)
    again = rollup.rollup_of_rollups(summary).select("market", F.col("sum_sales").alias("rolled_up"))
    regions = rollup.region_stats(priced.withColumn("order_region", F.col("market")))
    regions = regions.select(F.col("order_region").alias("market"), F.round("region_avg_sales", 9).alias("avg_sales"))
    return summary.select("market", "n_orders", "sum_sales").join(again, "market").join(regions, "market")


def kind_and_number(c: str) -> list[Column]:
    """A total that may be NaN or infinite: which of these it is, and the number if it is one."""
    x = F.col(c)
    kind = F.when(F.isnan(x), "NaN").when(x == float("inf"), "inf").when(x == -float("inf"), "-inf").otherwise("number")
    return [kind.alias(f"{c}_kind"), F.when(kind == "number", x).alias(c)]


@query("extreme_sums")
def q_extreme_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals and means with amounts that are NaN, infinite or beyond fixed point, on rollups by nation."""
    s = fixtures.shipments(spark, sf_dir)
    kind, odd = F.substring("order_region", 8, 2).cast("int") % 5, F.col("order_key") % 50 == 0
    amount = (
        F.when(odd & (kind == 0), F.lit(float("nan"))).when(odd & (kind == 1), F.lit(float("inf")))
        .when(odd & (kind == 2), F.when(F.col("line_number") % 2 == 0, F.lit(float("inf"))).otherwise(F.lit(-float("inf"))))
        .when(odd & (kind == 3), F.lit(float(2**60))).otherwise(F.col("sales"))
    )
    s = s.withColumn("sales", amount)
    stats = rollup.region_stats(s)
    summary = rollup.market_summary(s.drop("market"), out_key="order_region")
    again = rollup.rollup_of_rollups(summary, key="order_region").select("order_region", F.col("sum_sales").alias("rolled_up"))
    rows = summary.join(again, "order_region").join(stats, "order_region")
    parts = [p for c in ("sum_sales", "rolled_up", "region_avg_sales") for p in kind_and_number(c)]
    return rows.select("order_region", "n_orders", *parts)


# ---------------------------------------------------------------- schema
@query("normalize_columns")
def q_normalize_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schema.normalize_columns(fixtures.raw_orders(spark, sf_dir))


@query("select_present")
def q_select_present(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.operators.model import PREDICTION_COLUMNS

    wanted = [*PREDICTION_COLUMNS, "prediction", "prob_class_1"]
    return schema.select_present(fixtures.shipments(spark, sf_dir), wanted)


@query("ensure_column")
def q_ensure_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir).drop("delivery_days", "num_orders", "late_delivery_risk")
    out = features.add_delivery_features(df)
    return out.select(
        "order_key", "line_number", "delivery_days", "geo_distance_km", "num_orders", "late_delivery_risk"
    )


@query("cast_numeric")
def q_cast_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir).select("order_id", "customer_id", "line_number")
    return schema.cast_columns(df, {"order_id": "bigint", "customer_id": "bigint"})


@query("surrogate_key")
def q_surrogate_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir)
    return df.select(
        "order_key", "line_number",
        schema.surrogate_key(["order_id", "line_number", "customer_id", "market"]).alias("row_key"),
    )


# ---------------------------------------------------------------- columns
@query("late_label")
def q_late_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    return df.select(
        "order_key", "line_number",
        F.col("delivery_days").cast("double").alias("delivery_days"),  # nullable: compared as double
        late_flag("delivery_days").alias("late"),
    )


@query("parse_dates")
def q_parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir)
    return df.select(
        "order_key", "line_number",
        ts_text(parse_timestamp(F.concat(F.lit("  "), F.col("order_date_dateorders")))).alias("order_ts"),
        ts_text(parse_timestamp("shipping_date_dateorders")).alias("shipping_ts"),
    )


@query("delivery_days")
def q_delivery_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.functions.dates import day_diff

    df = fixtures.shipments(spark, sf_dir)
    return df.select(
        "order_key", "line_number",
        day_diff(parse_timestamp("shipping_date_dateorders"), parse_timestamp("order_date_dateorders")).alias(
            "delivery_days"
        ),
    )


@query("coerce_numeric")
def q_coerce_numeric(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.typed_events(spark, sf_dir)
    text = F.when(F.col("event_id") % 5 == 0, F.lit("n/a")).otherwise(
        F.concat(F.lit(" "), F.col("value").cast("string"))
    )
    return ev.select("event_id", coerce_double(text).alias("value_num"))


@query("coerce_typed_in")
def q_coerce_typed_in(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed-in values: whole numbers, other numbers, and text that stays as it was (FN-12)."""
    ev = fixtures.typed_events(spark, sf_dir)
    k = F.col("event_id")
    typed = (
        F.when(k % 4 == 0, F.concat(F.lit(" -"), k.cast("string")))
        .when(k % 4 == 1, F.concat((k % 1000).cast("string"), F.lit(".5 ")))
        .when(k % 4 == 2, F.concat(F.lit(" n/a "), k.cast("string")))
    )
    return ev.select("event_id", coerce_value(typed).alias("v")).select(
        "event_id", F.col("v.whole").cast("double").alias("whole"), F.col("v.number").alias("number"), F.col("v.text").alias("text")
    )


@query("haversine")
def q_haversine(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir)
    clat, clon = fixtures.coordinates("customer_key")
    slat, slon = fixtures.coordinates("supplier_key")
    return df.select(
        "order_key", "line_number", F.round(haversine_km(slat, slon, clat, clon), 6).alias("geo_distance_km")
    )


@query("impute_constant")
def q_impute_constant(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    cols = ["order_region", "customer_segment", "delivery_days", "benefit_per_order", "sales"]
    return clean.impute_constant(df, cols).select("order_key", "line_number", *cols)


@query("impute_median")
def q_impute_median(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    cols = ["order_region", "delivery_days", "sales"]
    return clean.impute_median(df, cols, exact=True).select("order_key", "line_number", *cols)


@query("median_columns")
def q_median_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    cols = ["delivery_days", "sales", "num_orders"]
    med = clean.column_medians(df, cols, exact=True)
    return spark.createDataFrame(
        [(c, None if med[c] is None else float(med[c])) for c in cols], "column_name string, median double"
    )


# ---------------------------------------------------------------- profile
@query("profile_missing")
def q_profile_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_missing(fixtures.dirty_shipments(spark, sf_dir))


@query("profile_counts")
def q_profile_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.profile_counts(fixtures.dirty_shipments(spark, sf_dir))


@query("drop_sparse_columns")
def q_drop_sparse_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir).select(
        "order_key", "line_number", "order_region", "customer_segment", "sales"
    )
    # sales is missing on 1/7 of rows, above the 0.1 threshold used here
    return profile.drop_sparse_columns(df, threshold=0.1)


@query("correlation_matrix")
def q_correlation_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    return profile.correlation_matrix(df, PROFILED)


@query("histogram")
def q_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.histogram(fixtures.shipments(spark, sf_dir), "delivery_days", 30)


@query("density_curve")
def q_density_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.density_curve(fixtures.shipments(spark, sf_dir), "delivery_days", 50)


@query("density_binned")
def q_density_binned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.binned_density(fixtures.shipments(spark, sf_dir), "sales", 50, cells=512)


@query("quantile_sketches")
def q_quantile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches stored per market and part of the orders, merged per market on read.

    The sketches hold up to 32,768 values each before they compress, so the
    quantiles of the small tables are exact.
    """
    from shiplens.operators.sketches import merged_quantiles, quantile_sketches

    s = fixtures.dirty_shipments(spark, sf_dir).withColumn("part", F.col("order_key") % 16)
    path = scratch(spark, "sketches")
    quantile_sketches(s, ["market", "part"], ["sales", "delivery_days"], k=32768).write.parquet(path)
    return merged_quantiles(spark.read.parquet(path), ["market"], ["sales", "delivery_days"], [0.1, 0.5, 0.99])


# Powers and products of the numeric columns: a table too wide for one aggregate per pair.
WIDE_POWERS = (1, 2, 3, 4, 5)


def wide_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir)
    base = {c: F.col(c).cast("double") / F.lit(1000.0 if c == "sales" else 10.0) for c in PROFILED}
    return df.select(*[F.pow(x, F.lit(float(p))).alias(f"{c}_{p}") for c, x in base.items() for p in WIDE_POWERS])


@query("wide_correlations")
def q_wide_correlations(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = wide_numbers(spark, sf_dir)
    return profile.correlation_matrix(df, df.columns)


@query("csv_quarantine")
def q_csv_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """CSV lines of the order export, some cut short, with a word for a number or a field too many: good and bad add up."""
    from shiplens.sources.tables import read_csv_tagged

    s = fixtures.shipments(spark, sf_dir).select("order_id", "customer_id", "sales", "num_orders", "market", "order_key")
    k = F.col("order_key")
    line = F.concat_ws(",", "order_id", "customer_id", "sales", "num_orders", "market")
    bad = (
        F.when(k % 50 == 0, F.concat_ws(",", "order_id", "customer_id", "sales"))
        .when(k % 97 == 0, F.concat_ws(",", "order_id", "customer_id", F.lit("n/a"), "num_orders", "market"))
        .when(k % 89 == 0, F.concat(line, F.lit(",extra")))
        .otherwise(line)
    )
    path = scratch(spark, "damaged-csv")
    s.select(bad.alias("value")).write.text(path)
    tagged = read_csv_tagged(spark, path, T.StructType.fromDDL("order_id string, customer_id string, sales double, num_orders int, market string"), header=False)
    return tagged.groupBy("status", "market").agg(F.count(F.lit(1)).alias("n_lines"), money_sum("sales").alias("sum_sales"), F.count("raw").alias("n_raw"))


# ---------------------------------------------------------------- sampling
@query("sample_hash")
def q_sample_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.shipments(spark, sf_dir)
    return features.sample_hash(df, ["order_id", "line_number"], 0.1).select("order_key", "line_number", "sales")


@query("split_hash")
def q_split_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = features.split_hash(fixtures.shipments(spark, sf_dir), ["order_id", "line_number"], 0.8)
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("late_delivery_risk").alias("n_late"),
        money_sum("sales").alias("sum_sales"),
    )


@query("feature_table")
def q_feature_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = fixtures.dirty_shipments(spark, sf_dir).withColumn("geo_distance_km", F.lit(0.0))
    return features.feature_table(df)


# ---------------------------------------------------------------- JSON
@query("json_decode")
def q_json_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = fixtures.typed_events(spark, sf_dir)
    from pyspark.sql import types as T

    return lines.decode_json(ev, T.StructType([T.StructField("k", T.IntegerType())]), col="props", keep=["event_id"])


def keyed_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.encode_json(fixtures.shipments(spark, sf_dir), fixtures.STREAM_FIELDS, keep=["order_key"])


@query("json_roundtrip")
def q_json_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.decode_json(fixtures.order_lines_json(spark, sf_dir))


@query("json_quarantine")
def q_json_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = keyed_lines(spark, sf_dir)
    damaged = lines.damaged_lines(raw, F.col("order_key"))
    tagged = lines.decode_with_quarantine(damaged)
    return tagged.groupBy("status").agg(
        F.count(F.lit(1)).alias("n_lines"),
        money_sum("sales").alias("sum_sales"),
    )


@query("late_events")
def q_late_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    # arrival order: order key then line; event time: the order date
    s = fixtures.shipments(spark, sf_dir).select(
        (F.col("order_key") * 8 + F.col("line_number")).alias("arrival"), "order_key", "line_number", "order_ts"
    )
    out = lateness.late_events(s, "arrival", "order_ts", delay_seconds=30 * 86400)
    return out.select(
        "order_key", "line_number", ts_text("prior_max_ts").alias("prior_max_ts"), "is_late"
    )


# ---------------------------------------------------------------- sources and sinks
def scratch(spark: SparkSession, name: str) -> str:
    """A fresh folder under the shared checkpoint location, deleted when the driver ends."""
    import uuid

    from shiplens.session import remove_at_exit, scratch_path

    path = scratch_path(spark, f"{name}-{uuid.uuid4().hex[:12]}")
    remove_at_exit(spark, path)
    return path


@query("src_csv_roundtrip")
def q_src_csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.sinks.files import write_csv
    from shiplens.sources.tables import read_csv

    raw = fixtures.raw_orders(spark, sf_dir)
    path = scratch(spark, "raw-orders-csv")
    write_csv(raw, path)
    back = read_csv(spark, path, schema=raw.schema)
    return schema.normalize_columns(back)


@query("sink_parquet_idempotent")
def q_sink_parquet_idempotent(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.sinks.files import write_parquet_batch

    hist = fixtures.agg_history(spark, sf_dir)
    first_half = F.dayofmonth("ts") <= 15
    path = scratch(spark, "history-batches")
    write_parquet_batch(hist.where(first_half), path, 0, col="micro_batch")
    write_parquet_batch(hist.where(~first_half), path, 1, col="micro_batch")
    # batch 1 replayed after a failure: replaces itself, adds nothing
    write_parquet_batch(hist.where(~first_half), path, 1, col="micro_batch")
    return history_text(spark.read.parquet(path).drop("micro_batch"))


@query("sink_parquet_overwrite")
def q_sink_parquet_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.sinks.files import write_parquet

    summary = rollup.market_summary(fixtures.shipments(spark, sf_dir))
    path = scratch(spark, "market-summary-parquet")
    write_parquet(summary, path)
    write_parquet(summary, path)  # overwrite, not append
    return spark.read.parquet(path)


@query("sink_csv_market_summary")
def q_sink_csv_market_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.sinks.files import write_csv
    from shiplens.sources.tables import read_csv

    summary = rollup.market_summary(fixtures.shipments(spark, sf_dir))
    path = scratch(spark, "market-summary-csv")
    write_csv(summary, path, single_file=True)  # one row per market
    return read_csv(spark, path, schema=summary.schema)


@query("agg_documents")
def q_agg_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.plans import jobs
    from shiplens.sinks import snapshots
    from shiplens.sinks.files import aggregate_documents, write_documents

    summary = rollup.market_summary(fixtures.shipments(spark, sf_dir))
    docs = aggregate_documents(summary, "market")
    path = scratch(spark, "documents")
    write_documents(docs, path, run="today")
    write_documents(docs, path, run="today")  # a rerun replaces its documents
    write_documents(docs.where("n_orders < 0"), path, run="empty")  # another run replaces nothing
    snapshots.compact(spark, path, partition_by=["day"])
    return jobs.read_documents(spark, path).drop("ts", "run", "day")


@query("agg_readback")
def q_agg_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.sinks.files import write_parquet

    from shiplens.plans import jobs

    hist = fixtures.agg_history(spark, sf_dir).withColumn("day", F.to_date("ts"))
    path = scratch(spark, "history-by-day")
    write_parquet(hist, path, partition_by=["day"])
    # the day predicate prunes partitions; ts/market are pushed to the scan
    picked = rollup.filter_market(jobs.pick_days(spark.read.parquet(path), "2024-01-05", "2024-01-10"), "view")
    return history_text(picked)


# ---------------------------------------------------------------- jobs
def run_prepare_job(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, str]:
    """JOB-1 over the raw order export written as CSV: (prepared table, sample path)."""
    from shiplens.plans import jobs
    from shiplens.sinks.files import write_csv

    raw = fixtures.raw_orders(spark, sf_dir)
    csv_path = scratch(spark, "raw-orders-export")
    write_csv(raw, csv_path)
    out = scratch(spark, "prepared")
    stored = jobs.prepare(spark, csv_path, out, sample_path=out + "-sample", csv_schema=raw.schema)
    return stored, out + "-sample"


def prepared_text(df: DataFrame) -> DataFrame:
    return df.withColumn("geo_distance_km", F.round("geo_distance_km", 6))


@query("job_prepare")
def q_job_prepare(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_text(run_prepare_job(spark, sf_dir)[0])


@query("job_prepare_sample")
def q_job_prepare_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared_text(spark.read.parquet(run_prepare_job(spark, sf_dir)[1]))


@query("job_train")
def q_job_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-2 on the prepared table, with a small forest: sizes of the split, and its metrics."""
    from shiplens.operators.model import load_model
    from shiplens.plans import jobs

    table = features.feature_table(features.add_delivery_features(schema.normalize_columns(fixtures.raw_orders(spark, sf_dir))))
    path = scratch(spark, "train-input")
    table.write.parquet(path)
    model_path = scratch(spark, "job-model")
    m = jobs.train(spark, path, model_path, allow_leak=True, num_trees=5)
    published.publish(forest.node_table(spark, model_path, load_model(model_path)), SMALL_FOREST)
    rows = spark.createDataFrame([(m["n_train"], m["n_test"], m["auc"], m["accuracy"])], "n_train long, n_test long, auc double, accuracy double")
    return rows.withColumns({"auc": F.round("auc", 9), "accuracy": F.round("accuracy", 9)})


@query("job_score")
def q_job_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-3 twice over one input, then over new data at its path: the documents of both runs, each once."""
    from shiplens.plans import jobs

    _, _, model_path = trained_model(spark, sf_dir)
    data, out, docs = (scratch(spark, f"score-{x}") for x in ("input", "predictions", "documents"))
    table = model_table(spark, sf_dir)
    for rows, times in ((table, 2), (table.where("split = 'test'"), 1)):
        rows.write.mode("overwrite").parquet(data)
        for _ in range(times):
            jobs.score(spark, data, model_path, out, docs)
    stored = jobs.read_documents(spark, docs)
    return stored.groupBy("market").agg(
        F.countDistinct("run").alias("n_runs"), F.sum("n_orders").cast("long").alias("n_orders"), F.round(F.sum("sum_sales"), 2).alias("sum_sales")
    )


@query("job_report")
def q_job_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-6 over documents stored by day: its five results as one long table."""
    from shiplens.plans import jobs
    from shiplens.sinks.files import write_documents

    path = scratch(spark, "report-documents")
    write_documents(fixtures.agg_history(spark, sf_dir), path, run="history", fmt="parquet")
    r = jobs.report(spark, jobs.read_documents(spark, path, "parquet"), "2024-01-05", "2024-01-20", latest=50)
    none = F.lit(None).cast("double")
    orders = F.col("n_orders").cast("double").alias("n_orders")
    sales = F.round("sum_sales", 2).alias("value")
    named = F.concat_ws("|", ts_text("ts"), "market")
    parts = [
        r["kpis"].select(F.lit("kpis").alias("section"), F.lit("all").alias("key"), F.col("total_orders").cast("double").alias("n_orders"), F.round("total_sales", 2).alias("value")),
        r["hourly"].select(F.lit("hourly").alias("section"), ts_text("ts").alias("key"), orders, none.alias("value")),
        r["by_market"].select(F.lit("by_market").alias("section"), F.col("market").alias("key"), orders, sales),
        r["latest"].select(F.lit("latest").alias("section"), named.alias("key"), orders, sales),
        r["markets"].select(F.lit("markets").alias("section"), F.col("market").alias("key"), none.alias("n_orders"), none.alias("value")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("job_profile")
def q_job_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-7 on the dirty order table: counts, missing values, correlations and histogram as one long table."""
    from shiplens.plans import jobs

    p = jobs.profile_table(fixtures.dirty_shipments(spark, sf_dir), "delivery_days", PROFILED)
    value = lambda c: F.col(c).cast("double").alias("value")
    parts = [
        p["counts"].select(F.lit("counts").alias("section"), F.lit("rows").alias("key"), value("n_rows")),
        p["missing"].select(F.lit("missing").alias("section"), F.col("column_name").alias("key"), value("n_missing")),
        p["correlations"].select(F.lit("correlations").alias("section"), F.concat_ws("|", "col_a", "col_b").alias("key"), value("r")),
        p["histogram"].select(F.lit("histogram").alias("section"), F.col("bin").cast("string").alias("key"), value("n")),
    ]
    return reduce(DataFrame.unionByName, parts)


@query("documents_readback")
def q_documents_readback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored documents whose ``ts`` is epoch seconds or ISO-8601 text (SRC-6, FN-15).

    Half the hourly documents carry ``ts`` as a JSON number, half as
    ISO text with a zone suffix, as documents from different writers do;
    the reader infers the column as text and parses both forms in place.
    """
    from shiplens.plans import jobs

    hist = fixtures.agg_history(spark, sf_dir)
    fields = ["market", "n_orders", "avg_delivery_days", "sum_sales", "batch_id"]
    as_epoch = F.to_json(F.struct(F.unix_timestamp("ts").alias("ts"), *fields))
    as_iso = F.to_json(F.struct(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("ts"), *fields))
    path = scratch(spark, "documents-json")
    hist.select(F.when(F.col("batch_id") % 2 == 0, as_epoch).otherwise(as_iso).alias("value")).write.text(path)
    return history_text(jobs.read_documents(spark, path))


# ---------------------------------------------------------------- streaming
EVENT_FILES = 4


def order_by_name(spark: SparkSession, path: str) -> None:
    """Give the files of a folder modification times in the order of their names.

    A file stream reads files by modification time; the files of a
    range-partitioned write are named in range order but finish in any.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((f for f in fs.listStatus(folder) if f.isFile()), key=lambda f: f.getPath().getName())
    first = min((f.getModificationTime() for f in files), default=0)
    for i, f in enumerate(files):
        fs.setTimes(f.getPath(), first + 1000 * i, -1)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as a file stream source with ``ts`` as event time."""
    from shiplens.sources.tables import read_table

    schema_ = read_table(spark, sf_dir, "events").schema
    # the events in time order over several files, so that there are several
    # batches and the watermark closes windows between them
    path = scratch(spark, "event-files")
    read_table(spark, sf_dir, "events").repartitionByRange(EVENT_FILES, "ts").write.parquet(path)
    order_by_name(spark, path)
    src = spark.readStream.schema(schema_).option("maxFilesPerTrigger", 1).option("latestFirst", False).parquet(path)
    return src.withColumn("ts", F.col("ts").cast("timestamp"))


def window_text(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("event_type").alias("market"),
        "n_events",
        "avg_sales",
        ts_text("window_start").alias("window_start"),
        ts_text("window_end").alias("window_end"),
    )


@query("window_tumbling")
def q_window_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import windowed_stats

    ev = fixtures.typed_events(spark, sf_dir)
    out = windowed_stats(ev, "ts", key="event_type", window="1 hour", watermark=None, days_col=None,
                         sales_col="value")
    return window_text(out)


ORDER_WINDOW = "30 days"


def order_window_text(df: DataFrame) -> DataFrame:
    return df.select(
        "market", "n_events", F.round("avg_delivery_days", 6).alias("avg_delivery_days"), "avg_sales",
        ts_text("window_start").alias("window_start"), ts_text("window_end").alias("window_end"),
    )


@query("window_orders")
def q_window_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order windows with the mean delivery days, as a batch."""
    from shiplens.streaming.windows import windowed_stats

    s = fixtures.shipments(spark, sf_dir)
    return order_window_text(windowed_stats(s, "order_ts", window=ORDER_WINDOW, watermark=None))


@query("stream_window_update")
def q_stream_window_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order windows with the mean delivery days, updated batch by batch over several files.

    The order time of a line is unrelated to its arrival here, so the
    watermark is wide enough that no line is late.
    """
    from shiplens.streaming.windows import enrich_orders, run_available, windowed_stats

    path = write_line_files(spark, sf_dir)
    src = lines.read_lines_stream(spark, "text", path, {"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER})
    stats = windowed_stats(enrich_orders(lines.decode_json(src)), "order_ts", window=ORDER_WINDOW, watermark="36500 days")
    base = scratch(spark, "stream-window-update")
    res = run_available(stats, f"{base}/out", f"{base}/checkpoint", mode="update", keys=["market", "window_start", "window_end"])
    return order_window_text(res)


@query("job_stream_windows")
def q_job_stream_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-4 on damaged lines in several files: every line is in a window or in quarantine."""
    from shiplens.plans import jobs
    from shiplens.sinks.files import write_lines
    from shiplens.streaming.windows import run_streams

    path = scratch(spark, "damaged-lines")
    write_lines(lines.damaged_lines(keyed_lines(spark, sf_dir), F.col("order_key")), path)
    base = scratch(spark, "job-windows")
    options = {"trigger": {"availableNow": True}, "source_options": {"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER}}
    run_streams([
        jobs.stream_windows(spark, path, f"{base}/windows", f"{base}/ck-windows", mode="complete", **options),
        jobs.stream_quarantine(spark, path, f"{base}/bad", f"{base}/ck-bad", **options),
    ])
    good = spark.read.parquet(f"{base}/windows").groupBy("market").agg(
        F.sum("n_events").cast("long").alias("n_events"),
        F.round(F.sum(F.col("avg_delivery_days") * F.col("n_events")) / F.sum("n_events"), 6).alias("avg_delivery_days"),
    )
    bad = spark.read.parquet(f"{base}/bad").agg(F.count(F.lit(1)).alias("n_events"))
    return good.unionByName(bad.select(F.lit("(quarantine)").alias("market"), "n_events", F.lit(None).cast("double").alias("avg_delivery_days")))


@query("stream_window")
def q_stream_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import run_available, windowed_stats

    out = windowed_stats(events_stream(spark, sf_dir), "ts", key="event_type", window="1 hour",
                         watermark="30 seconds", days_col=None, sales_col="value")
    base = scratch(spark, "stream-window")
    keys = ["event_type", "window_start", "window_end"]
    # changed windows only per batch; the watermark evicts closed ones from the state
    res = run_available(out, f"{base}/out", f"{base}/checkpoint", mode="update", keys=keys)
    return window_text(res)


@query("stream_window_append")
def q_stream_window_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import run_available, windowed_stats

    out = windowed_stats(events_stream(spark, sf_dir), "ts", key="event_type", window="1 hour",
                         watermark="30 seconds", days_col=None, sales_col="value")
    base = scratch(spark, "stream-window-append")
    res = run_available(out, f"{base}/out", f"{base}/checkpoint", mode="append")
    return window_text(res)


@query("stream_state_audit")
def q_stream_state_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Windows that an append query emitted, and those still open in its state: together all windows."""
    from shiplens.streaming.late import open_windows
    from shiplens.streaming.windows import run_available, windowed_stats

    out = windowed_stats(events_stream(spark, sf_dir), "ts", key="event_type", window="1 hour",
                         watermark="30 seconds", days_col=None, sales_col="value")
    base = scratch(spark, "stream-audit")
    emitted = run_available(out, f"{base}/out", f"{base}/checkpoint", mode="append")
    still = open_windows(spark, f"{base}/checkpoint", key="event_type", days=False)
    state = F.lit("open").alias("state")
    return window_text(emitted).withColumn("state", F.lit("emitted")).unionByName(window_text(still).select("*", state))


LATE_FILES, LATE_DELAY = 4, "1800 days"


@query("stream_late_split")
def q_stream_late_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Damaged lines on event time in four deliveries that arrive one by one: windows, late lines and quarantine add up.

    Runs under a processing-time trigger until all deliveries are read, then stops.  Each
    delivery is a folder of many files, written elsewhere and renamed into the
    source, so the stream sees it whole, as one batch.
    """
    from shiplens.plans import jobs
    from shiplens.sinks.files import write_lines
    from shiplens.streaming.late import read_windows
    from shiplens.sinks import snapshots

    keyed, staged_path = stage_table(keyed_lines(spark, sf_dir), "late-lines")
    path, drafts = scratch(spark, "late-line-files"), scratch(spark, "late-line-drafts")
    base = scratch(spark, "late-split")
    q = None
    try:
        for i in range(LATE_FILES):
            part = keyed.where(F.col("order_key") % LATE_FILES == i)
            write_lines(lines.damaged_lines(part, F.col("order_key")), f"{drafts}/d{i}")
            rename_folder(spark, f"{drafts}/d{i}", f"{path}/d{i}")
            if q is None:
                q = jobs.stream_late_windows(
                    spark, f"{path}/*", base, f"{base}/checkpoint", window=ORDER_WINDOW, watermark=LATE_DELAY,
                    trigger={"processingTime": "1 second"}, compact_every=2,
                )
            q.processAllAvailable()
    finally:
        if q is not None:
            q.stop()
    remove_path(spark, staged_path)
    none = F.lit(None).cast("string")
    opened = read_windows(spark, base).select(
        F.lit("window").alias("kind"), "market", ts_text("window_start").alias("window_start"), "n_events", "avg_sales",
        F.round("avg_delivery_days", 6).alias("avg_delivery_days"),
    )
    count = F.count(F.lit(1)).alias("n_events")
    late_rows = snapshots.read_runs(spark, f"{base}/late", "parquet").groupBy("market").agg(count)
    bad = snapshots.read_runs(spark, f"{base}/quarantine", "parquet").agg(count)
    parts = [opened, late_rows.select(F.lit("late").alias("kind"), "market", none.alias("window_start"), "n_events"),
             bad.select(F.lit("quarantine").alias("kind"), none.alias("market"), none.alias("window_start"), "n_events")]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


# Rate limit of the line streams: a micro-batch has a fixed cost (planning,
# commit log, sink writes), so each one should carry several files.  The
# line files number the join's output partitions, so batches still grow
# with the data.
LINE_FILES_PER_TRIGGER = 8


def write_line_files(spark: SparkSession, sf_dir: str) -> str:
    """The order lines as compressed text files in a fresh folder.

    Written straight from the join's output partitions (no extra shuffle), so
    the number of files, and of micro-batches at one file per trigger, grows
    with the data.
    """
    from shiplens.sinks.files import write_lines

    path = scratch(spark, "order-lines")
    write_lines(keyed_lines(spark, sf_dir).select("value"), path)
    return path


@query("stream_lines")
def q_stream_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import run_available

    path = write_line_files(spark, sf_dir)
    src = lines.read_lines_stream(spark, "text", path, {"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER})
    base = scratch(spark, "stream-lines")
    landed = run_available(src, f"{base}/out", f"{base}/checkpoint", mode="append")
    return landed.agg(F.count(F.lit(1)).alias("n_lines"))


@query("stream_enrich")
def q_stream_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import enrich_orders, run_available

    path = write_line_files(spark, sf_dir)
    src = lines.read_lines_stream(spark, "text", path, {"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER})
    enriched = enrich_orders(lines.decode_json(src)).drop("ingest_ts")
    base = scratch(spark, "stream-enrich")
    landed = run_available(enriched, f"{base}/out", f"{base}/checkpoint", mode="append")
    return landed.select(
        "order_id", ts_text("order_ts").alias("order_ts"), ts_text("shipping_ts").alias("shipping_ts"),
        "delivery_days",
    )


@query("stream_batch_rollup")
def q_stream_batch_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.streaming.windows import batch_rollup_writer, enrich_orders, run_streams, start_foreach

    path = write_line_files(spark, sf_dir)
    src = lines.read_lines_stream(spark, "text", path, {"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER})
    enriched = enrich_orders(lines.decode_json(src))
    base = scratch(spark, "stream-rollup")
    q = start_foreach(enriched, batch_rollup_writer(f"{base}/docs"), f"{base}/checkpoint")
    run_streams([q])  # availableNow: ends once all input is processed
    docs = spark.read.parquet(f"{base}/docs")
    return docs.groupBy("market").agg(
        F.sum("n_orders").cast("long").alias("n_orders"),
        money_sum("sum_sales").alias("sum_sales"),
    )


# ---------------------------------------------------------------- model
MODEL_CATEGORICAL = ["shipping_mode", "customer_segment", "order_region"]


@query("string_index")
def q_string_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.operators import model as ml

    df = fixtures.shipments(spark, sf_dir)
    indexer = ml.build_pipeline(MODEL_CATEGORICAL, ["sales"]).getStages()[0]
    t = indexer.fit(df).transform(df)
    pieces = [e for c in MODEL_CATEGORICAL for e in (F.lit(c), F.col(c), F.col(f"{c}_idx").cast("int"))]
    long = t.select(F.stack(F.lit(len(MODEL_CATEGORICAL)), *pieces).alias("column_name", "value", "idx"))
    return long.groupBy("column_name", "value", "idx").agg(F.count(F.lit(1)).alias("n"))


@query("one_hot")
def q_one_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from shiplens.operators import model as ml

    df = fixtures.shipments(spark, sf_dir)
    stages = ml.build_pipeline(["customer_segment"], ["sales"]).getStages()[:2]
    t = Pipeline(stages=stages).fit(df).transform(df)
    slots = F.array_join(vector_to_array("customer_segment_ohe").cast("array<int>"), ",")
    return t.groupBy("customer_segment", slots.alias("one_hot")).agg(F.count(F.lit(1)).alias("n"))


@query("standard_scale")
def q_standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.ml import Pipeline
    from pyspark.ml.functions import vector_to_array

    from shiplens.operators import model as ml

    df = fixtures.shipments(spark, sf_dir)
    stages = ml.build_pipeline([], ["sales", "delivery_days"]).getStages()[:-1]  # assembled and scaled
    t = Pipeline(stages=stages).fit(df).transform(df).select("order_key", "line_number", vector_to_array("features").alias("v"))
    return t.select(
        "order_key", "line_number",
        F.round(F.col("v")[0], 6).alias("scaled_sales"),
        F.round(F.col("v")[1], 6).alias("scaled_delivery_days"),
    )


def model_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table with a key-hash train/test split, as the training job builds it."""
    s = features.add_delivery_features(fixtures.with_coordinates(fixtures.shipments(spark, sf_dir)))
    table = features.feature_table(s, ids=["order_id", "customer_id", "market", "line_number"])
    return features.split_hash(table, ["order_id", "line_number"], 0.8)


_MODELS: dict[tuple, tuple] = {}
# Names of the published node tables, which the SQL of the model queries reads.
FOREST, SMALL_FOREST = "late-forest", "job-forest"


def trained_model(spark: SparkSession, sf_dir: str):
    """(model read back from storage, training result, path), trained once per application and table."""
    from shiplens.operators import model as ml

    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _MODELS:
        _MODELS[key] = _train_and_store(spark, sf_dir, ml)
    model, _, path = _MODELS[key]
    published.publish(forest.node_table(spark, path, model), FOREST)
    return _MODELS[key]


def _train_and_store(spark: SparkSession, sf_dir: str, ml) -> tuple:
    # the reference trains with delivery_days although the label is derived from it
    res = ml.train_late_model(model_table(spark, sf_dir), allow_leak=True)
    path = scratch(spark, "late-model")
    ml.save_model(res.model, path)
    return ml.load_model(path), res, path


@query("train_late_model")
def q_train_late_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sizes of the split and the forest, and the metrics of the held-out rows."""
    model, res, _ = trained_model(spark, sf_dir)
    trees = model.stages[-1]
    return spark.createDataFrame(
        [(int(res.n_train), int(res.n_test), int(trees.getNumTrees), int(trees.numFeatures), res.auc, res.accuracy)],
        "n_train long, n_test long, num_trees int, num_features int, auc double, accuracy double",
    ).withColumns({"auc": F.round("auc", 9), "accuracy": F.round("accuracy", 9)})


def scores(scored: DataFrame) -> DataFrame:
    """Probabilities without the digits that depend on the order of adding votes."""
    return scored.withColumn("prob_class_1", F.round("prob_class_1", PROBABILITY_DIGITS))


@query("score_batch")
def q_score_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    from shiplens.operators import model as ml

    model, _, _ = trained_model(spark, sf_dir)
    return scores(ml.score(model, model_table(spark, sf_dir)))


@query("score_natively")
def q_score_natively(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores by the whole forest as native CASE columns, without model classes."""
    from shiplens.operators import model as ml

    model, _, path = trained_model(spark, sf_dir)
    nodes = forest.node_table(spark, path, model)
    rows = forest.scored_natively(ml.fill_inputs(model, model_table(spark, sf_dir)), nodes)
    return scores(schema.select_present(rows, [*ml.PREDICTION_COLUMNS, "prediction", "prob_class_1"]))


@query("evaluate_model")
def q_evaluate_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC and accuracy of the held-out rows."""
    from shiplens.operators import model as ml

    model, _, _ = trained_model(spark, sf_dir)
    auc, acc, n = ml.evaluate_with_count(model.transform(model_table(spark, sf_dir).where(F.col("split") == "test")))
    rows = spark.createDataFrame([(n, auc, acc)], "n_test long, auc double, accuracy double")
    return rows.withColumns({"auc": F.round("auc", 9), "accuracy": F.round("accuracy", 9)})


@query("rank_sum_auc")
def q_rank_sum_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Exact AUC of plain columns as scores for the late label, with ties, over all rows."""
    from shiplens.operators.ranking import rank_sum

    s = fixtures.dirty_shipments(spark, sf_dir).select("late_delivery_risk", "sales", "num_orders", "delivery_days")
    staged, path = stage_table(s, "auc-rows")
    rows = []
    for c in ("sales", "num_orders", "delivery_days"):
        r = rank_sum(staged, "late_delivery_risk", c)
        rows.append((c, r.positives, r.negatives, r.auc))
    remove_path(spark, path)
    return spark.createDataFrame(rows, "score string, positives long, negatives long, auc double").withColumn("auc", F.round("auc", 12))


@query("confusion_matrix")
def q_confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out rows per label and predicted class."""
    from shiplens.operators import model as ml

    model, _, _ = trained_model(spark, sf_dir)
    return ml.confusion_counts(model.transform(model_table(spark, sf_dir).where(F.col("split") == "test")))


@query("score_uploaded_csv")
def q_score_uploaded_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SRC-7: the raw order export as an uploaded CSV, scored by the saved model."""
    from shiplens.plans import jobs
    from shiplens.sinks.files import write_csv

    _, _, model_path = trained_model(spark, sf_dir)
    raw = fixtures.raw_orders(spark, sf_dir)
    path = scratch(spark, "upload-csv")
    write_csv(raw, path)
    return scores(jobs.score_csv(spark, path, model_path, csv_schema=raw.schema))


@query("stream_score")
def q_stream_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JOB-5 over several files: lines, stored documents and the predicted lateness per market."""
    from shiplens.plans import jobs
    from shiplens.streaming.windows import run_streams

    _, _, model_path = trained_model(spark, sf_dir)
    path = write_line_files(spark, sf_dir)
    base = scratch(spark, "stream-score")
    q = jobs.stream_score(
        spark, path, model_path, f"{base}/predictions", f"{base}/ck", f"{base}/quarantine", f"{base}/documents",
        trigger={"availableNow": True}, source_options={"maxFilesPerTrigger": LINE_FILES_PER_TRIGGER},
    )
    run_streams([q])  # availableNow: ends once all input is processed
    rows = scores(spark.read.parquet(f"{base}/predictions")).groupBy("market").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.sum("prediction").cast("long").alias("n_late"),
        F.round(F.sum(F.col("prob_class_1").cast("decimal(18,8)")).cast("double"), 3).alias("expected_late"),
    )
    docs = spark.read.parquet(f"{base}/documents").groupBy("market").agg(F.sum("n_orders").cast("long").alias("n_documented"))
    return rows.join(docs, "market")
