"""Rollups and reporting operators (AGG-1, 2, 6..9, FLT-1/2, SRT-1..3, JON-1).

All groupings use ``groupBy().agg()`` so Spark runs a partial (map-side)
aggregation before the shuffle: a key that holds a third of all rows costs
one partial row per input partition, never one oversized task.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.dates import day_bounds
from shiplens.functions.numeric import money_mean, money_sum
from shiplens.operators.joins import is_small
from shiplens.operators.schema import quoted, resolve
from shiplens.session import stage_table

GROUP_ALIASES = ("market", "order_region")


def market_summary(
    df: DataFrame,
    group_aliases: Sequence[str] = GROUP_ALIASES,
    days_col: str = "delivery_days",
    sales_col: str = "sales",
    out_key: str = "market",
) -> DataFrame:
    """Orders, mean delivery days and total sales per market (AGG-1).

    Falls back to the next available grouping column (region) when there is
    no market column.  Sales are summed in fixed point so the total does not
    depend on partitioning; NaN, infinities and amounts beyond fixed point follow
    :func:`functions.numeric.money_sum`, here and in all rollups.
    """
    key = resolve(df, group_aliases)
    if key is None:
        raise ValueError(f"none of {list(group_aliases)} is a column")
    return df.groupBy(F.col(quoted(key)).alias(out_key)).agg(
        F.count(F.lit(1)).alias("n_orders"),
        F.avg(days_col).alias("avg_delivery_days"),
        money_sum(sales_col).alias("sum_sales"),
    )


def region_stats(
    df: DataFrame,
    key: str = "order_region",
    sales_col: str = "sales",
    days_col: str = "delivery_days",
) -> DataFrame:
    """Per-region order count, mean sales and mean delivery days (AGG-2)."""
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias("region_order_count"),
        money_mean(sales_col).alias("region_avg_sales"),
        F.avg(days_col).alias("region_avg_delivery_days"),
    )


# Rows one task of a salted join-back should hold, and the most keys that
# may be split (the broadcast list of hot keys is at most this long).
TARGET_ROWS_PER_TASK = 1_000_000
MAX_HOT_KEYS = 100_000


def rows_per_task(total: int, target_rows: int = TARGET_ROWS_PER_TASK, max_hot_keys: int = MAX_HOT_KEYS) -> int:
    """Rows per salt: ``target_rows``, raised so that fewer than ``max_hot_keys`` keys exceed it."""
    return max(1, target_rows, -(-total // max_hot_keys))


def hot_keys(
    stats: DataFrame,
    key: str,
    count_col: str,
    target_rows: int = TARGET_ROWS_PER_TASK,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Keys holding more rows than one task should, with a salt count each.

    A key with ``count`` rows gets ``ceil(count / per_task)`` salts -- no cap,
    so a key holding a third of all rows is cut into pieces of at most
    ``per_task`` rows however large the table grows.  ``per_task`` is
    ``target_rows``, raised to ``total / max_hot_keys`` on huge tables, so
    fewer than ``max_hot_keys`` keys can pass: the result has a proven size
    bound and is safe to broadcast.  The salts of all hot keys sum to less
    than ``2 * total / per_task``, which bounds the replicated stats rows.
    """
    total = stats.agg(F.sum(count_col)).first()[0] or 0
    per_task = rows_per_task(int(total), target_rows, max_hot_keys)
    return stats.where(F.col(count_col) > per_task).select(
        key, F.ceil(F.col(count_col) / F.lit(per_task)).cast("int").alias("__s")
    )


def join_group_stats(
    df: DataFrame,
    stats: DataFrame,
    key: str,
    count_col: str | None = None,
    target_rows: int = TARGET_ROWS_PER_TASK,
    max_hot_keys: int = MAX_HOT_KEYS,
) -> DataFrame:
    """Left-join per-group statistics back onto every row (JON-1).

    The statistics are staged once.  When they are small (checked rows and
    bytes) they are broadcast, and the fact table is not shuffled at all.
    Otherwise the join is shuffled, and with ``count_col`` given, hot keys are
    salted (:func:`hot_keys`): a key holding a third of all rows is spread
    over as many tasks as its size needs.  The stats rows of hot keys only
    are replicated once per salt; every row matches exactly one replica, so
    the result is exact whatever salt a row draws.

    A null key gets null statistics (unlike a window over the key); those rows
    can't match, so they never enter the shuffle.

    The salt hashes the row's values and the number of its input partition:
    a task that is retried sends every row to the same replica again, and
    copies of one row in different partitions still spread.
    """
    stats, _ = stage_table(stats, "group-stats")
    if is_small(stats):
        return df.join(F.broadcast(stats), on=key, how="left")
    keyed = df.where(F.col(key).isNotNull())
    if count_col is None:
        joined = keyed.join(stats, on=key, how="left")
    else:
        hot = F.broadcast(hot_keys(stats, key, count_col, target_rows, max_hot_keys))
        salts = F.coalesce(F.col("__s"), F.lit(1))
        row_hash = F.xxhash64(*[F.col(quoted(c)) for c in df.columns], F.spark_partition_id())
        left = keyed.join(hot, on=key, how="left").withColumn("__salt", F.pmod(row_hash, salts).cast("int"))
        right = stats.join(hot, on=key, how="left").withColumn("__salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("__s")
        joined = left.join(right, on=[key, "__salt"], how="left").drop("__s", "__salt")
    rest = df.where(F.col(key).isNull()).select(
        F.col(quoted(key)),
        *[F.col(quoted(c)) for c in df.columns if c != key],
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in stats.schema.fields if f.name != key],
    )
    return joined.unionByName(rest)


def filter_time_range(df: DataFrame, date_from: str, date_to: str, ts_col: str = "ts") -> DataFrame:
    """Rows whose timestamp falls on the inclusive whole-day range (FLT-1).

    Expressed as literal bounds so the predicate reaches the parquet scan.
    """
    lo, hi = day_bounds(date_from, date_to)
    return df.where((F.col(ts_col) >= lo) & (F.col(ts_col) < hi))


def filter_market(df: DataFrame, market: str | None, col: str = "market") -> DataFrame:
    """Equality on market; blank or None keeps every row (FLT-2)."""
    if market is None or not market.strip():
        return df
    return df.where(F.col(col) == F.lit(market.strip()))


def dashboard_kpis(df: DataFrame) -> DataFrame:
    """Total orders, mean of the per-row averages, total sales (AGG-6).

    ``avg_delivery_days`` is the plain mean of stored averages, as the
    dashboard shows it; ``weighted_avg_delivery_days`` weights each average
    by its order count.
    """
    return df.agg(
        F.coalesce(F.sum("n_orders"), F.lit(0)).cast("long").alias("total_orders"),
        F.avg("avg_delivery_days").alias("avg_delivery_days"),
        F.try_divide(
            F.sum(F.col("avg_delivery_days") * F.col("n_orders")),
            F.sum(F.when(F.col("avg_delivery_days").isNotNull(), F.col("n_orders"))),
        ).alias("weighted_avg_delivery_days"),
        F.coalesce(money_sum("sum_sales"), F.lit(0.0)).alias("total_sales"),
    )


def rollup_of_rollups(df: DataFrame, key: str = "market") -> DataFrame:
    """Stored aggregates rolled up again by market, null markets dropped (AGG-7)."""
    return (
        df.where(F.col(key).isNotNull())
        .groupBy(key)
        .agg(
            F.sum("n_orders").cast("long").alias("n_orders"),
            F.avg("avg_delivery_days").alias("avg_delivery_days"),
            money_sum("sum_sales").alias("sum_sales"),
        )
    )


def resample_hourly(df: DataFrame, ts_col: str = "ts", value_col: str = "n_orders", by: Sequence[str] = ()) -> DataFrame:
    """Hourly sums with every hour between the first and last present (AGG-8).

    With ``by`` each group has its own first and last hour.  The hourly sums
    are staged once and read twice: for the bounds, and for the join with the
    spine.  A group's spine starts as its days, one entry each; the days are
    spread over the tasks before each becomes its 24 hours, so a long gap
    (one wrong timestamp) costs rows, not one large task.  Empty hours get 0.
    """
    hour = F.floor(F.unix_timestamp(F.col(ts_col).cast("timestamp")) / 3600)
    sums = df.where(F.col(ts_col).isNotNull()).groupBy(*by, hour.alias("hour")).agg(F.sum(value_col).alias("total"))
    hourly, _ = stage_table(sums, "hourly")
    bounds = hourly.groupBy(*by).agg(F.min("hour").alias("lo"), F.max("hour").alias("hi")).where("lo is not null")
    days = bounds.select("*", F.explode(F.sequence(F.floor(F.col("lo") / 24), F.floor(F.col("hi") / 24))).alias("day"))
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    hours = days.repartition(n, *by, "day").select(
        "*", F.explode(F.sequence(F.col("day") * 24, F.col("day") * 24 + 23)).alias("h")
    )
    spine = hours.where(F.col("h").between(F.col("lo"), F.col("hi"))).select(*[F.col(c).alias(f"__{c}") for c in by], "h")
    same = reduce(lambda a, c: a & F.col(f"__{c}").eqNullSafe(F.col(c)), by, F.col("h") == F.col("hour"))
    return spine.join(hourly, same, "left").select(
        *[F.col(f"__{c}").alias(c) for c in by],
        F.timestamp_seconds(F.col("h") * 3600).alias(ts_col),
        F.coalesce(F.col("total"), F.lit(0)).cast("long").alias(value_col),
    ).orderBy(*by, ts_col)


def distinct_values(df: DataFrame, col: str = "market") -> DataFrame:
    """Sorted distinct non-null values of a column (AGG-9)."""
    return df.where(F.col(col).isNotNull()).select(col).distinct().orderBy(col)


def latest_n(df: DataFrame, n: int = 200, ts_col: str = "ts", tie_break: Sequence[str] = ()) -> DataFrame:
    """The last ``n`` rows by time, returned oldest first (SRT-1/2).

    ``orderBy(desc).limit(n)`` plans as a top-k (TakeOrderedAndProject): each
    task keeps only its best ``n`` rows, so nothing unbounded moves.
    """
    if not 1 <= n:
        raise ValueError("n must be positive")
    desc = [F.col(ts_col).desc()] + [F.col(c).desc() for c in tie_break]
    asc = [F.col(ts_col).asc()] + [F.col(c).asc() for c in tie_break]
    return df.orderBy(*desc).limit(n).orderBy(*asc)


def first_n(df: DataFrame, n: int, order: Sequence[str | Column]) -> DataFrame:
    """Deterministic preview: the first ``n`` rows in a stated order (SRT-3)."""
    return df.orderBy(*order).limit(n)
