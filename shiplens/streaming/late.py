"""Windows beside their late lines, and the state a stream still holds (STR-1, STR-3, STR-4).

:func:`late_writer` is a ``foreachBatch`` callback that accounts for every
line: into a window, into the late lines, or into quarantine.  A line is late when its
window ended at or before the watermark of the batches before it (greatest event time
minus the delay); a line without an event time can't be in a window and goes with
the late ones.  Windows are kept as sums per batch, added up when read, so a
batch replayed after a failure replaces its own sums, late lines and watermark.

:func:`open_windows` reads what a windowed query in append mode has not emitted
yet from its state store.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shiplens.functions.numeric import LARGE, SUM_SCALE, money
from shiplens.sinks import snapshots
from shiplens.sources.lines import split_quarantine
from shiplens.streaming.windows import WATERMARK_DELAY, WINDOW_DURATION, enrich_orders

KEYS = ["market", "window_start", "window_end"]


def watermark_before(spark: SparkSession, path: str, batch_id: int, delay: str):
    """Greatest event time of the batches before ``batch_id`` less ``delay``; None before the first one with a time."""
    if not snapshots.exists(spark, path):
        return None
    seen = snapshots.read_runs(spark, path, "parquet").where(F.col("batch") < batch_id)
    return seen.agg((F.max("max_ts") - F.expr(f"interval {delay}")).alias("w")).first()["w"]


def _sums() -> list[Column]:
    """Sums that add up over batches, under the rule of :func:`functions.numeric.money_sum`."""
    x = F.col("sales").cast("double")
    ordinary = F.abs(x) < LARGE
    return [
        F.count(F.lit(1)).alias("n_events"),
        F.sum(F.col("delivery_days").cast("long")).alias("days"),
        F.count("delivery_days").alias("n_days"),
        F.sum(F.when(ordinary, money("sales", SUM_SCALE))).alias("fixed"),
        F.sum(F.when(~ordinary, x)).alias("large"),
        F.count("sales").alias("n_sales"),
    ]


def late_writer(
    base_path: str,
    event_time: str,
    window: str = WINDOW_DURATION,
    delay: str = WATERMARK_DELAY,
    compact_every: int = 0,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` callback over :func:`sources.lines.decode_with_quarantine` output.

    Writes the tables ``windows``, ``late``, ``quarantine`` and ``watermarks``
    under ``base_path`` (:mod:`sinks.snapshots`), the watermark last.
    """
    write = {name: snapshots.batch_writer(f"{base_path}/{name}", compact_every) for name in ("windows", "late", "quarantine", "watermarks")}

    def split(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        before = watermark_before(spark, f"{base_path}/watermarks", batch_id, delay)
        batch = batch.persist()
        try:
            good, bad = split_quarantine(batch)
            rows = enrich_orders(good)
            ts = F.col(event_time)
            # Spark drops rows without a time wherever it computes a window, so they are set apart first
            dated, undated = rows.where(ts.isNotNull()).withColumn("__w", F.window(ts, window)), rows.where(ts.isNull())
            ended = F.lit(False) if before is None else F.col("__w.end") <= F.lit(before)
            sums = dated.where(~ended).groupBy("market", "__w").agg(*_sums())
            sums = sums.select("market", F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"), *sums.columns[2:])
            write["windows"](sums, batch_id)
            write["late"](dated.where(ended).drop("__w").unionByName(undated), batch_id)
            write["quarantine"](bad, batch_id)
            write["watermarks"](rows.agg(F.lit(batch_id).cast("long").alias("batch"), F.max(ts).alias("max_ts")), batch_id)
        finally:
            batch.unpersist()

    return split


def read_windows(spark: SparkSession, base_path: str) -> DataFrame:
    """The windows of all batches: events, mean delivery days and mean sales."""
    parts = snapshots.read_runs(spark, f"{base_path}/windows", "parquet")
    total = parts.groupBy(*KEYS).agg(*[F.sum(c).alias(c) for c in ("n_events", "days", "n_days", "fixed", "large", "n_sales")])
    fixed = F.col("fixed").cast("double")
    sales = F.when(F.col("large").isNull(), fixed).otherwise(F.col("large") + F.coalesce(fixed, F.lit(0.0)))
    return total.select(
        *KEYS,
        F.col("n_events").cast("long").alias("n_events"),
        F.try_divide(F.col("days").cast("double"), F.col("n_days")).alias("avg_delivery_days"),
        F.try_divide(sales, F.col("n_sales")).alias("avg_sales"),
    )


def open_windows(spark: SparkSession, checkpoint: str, key: str = "market", days: bool = True) -> DataFrame:
    """Windows of a :func:`streaming.windows.windowed_stats` query that its state still holds.

    In append mode a window is emitted once the watermark passes its end, so
    emitted and open windows together are those of the whole input.  The
    state holds the sums of the aggregates; their layout is checked.
    """
    state = spark.read.format("statestore").load(checkpoint)
    layout = [("n_events", "bigint"), *([("days", "double"), ("n_days", "bigint")] if days else [])]
    layout += [("large", "double"), ("fixed", "decimal(38,10)"), ("empty", "boolean"), ("n_sales", "bigint")]
    found = [f.dataType.simpleString() for f in state.schema["value"].dataType.fields]
    if found != [kind for _, kind in layout]:
        raise ValueError(f"the state holds {found}, not the sums of a windowed query")
    named = F.col("value").cast(f"struct<{', '.join(f'{n}: {kind}' for n, kind in layout)}>")
    rows = state.select(F.col("key.window").alias("w"), F.col(f"key.{key}").alias(key), named.alias("v"))
    fixed = F.col("v.fixed").cast("double")
    sales = F.when(F.col("v.large").isNull(), fixed).otherwise(F.col("v.large") + F.coalesce(fixed, F.lit(0.0)))
    mean_days = [F.try_divide(F.col("v.days"), F.col("v.n_days")).alias("avg_delivery_days")] if days else []
    mean = F.try_divide(sales, F.col("v.n_sales")).alias("avg_sales")
    return rows.select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), key, "v.n_events", *mean_days, mean)
