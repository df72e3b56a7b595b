"""Late-event report (STR-4): rows older than the running event-time maximum.

An event is late when its time is more than ``delay`` behind the greatest
event time seen among rows that arrived strictly before it -- what a
watermark of that delay would drop.

The running maximum is a prefix scan over arrival order.  A window without
``partitionBy`` would funnel every row through one task, so the rows are cut
into ranges of the arrival number:

1. the input is computed once and staged; a bounded sample of its arrival
   numbers gives the bounds of the ranges;
2. each range's greatest time (one row per range, so safe to broadcast) becomes
   the greatest time of all earlier ranges;
3. the rows are shuffled once, by range, and a window inside each range adds the
   maximum of its smaller arrival numbers.

An arrival number that fills ranges on its own gets a range for itself, cut
into as many pieces as it fills: its rows arrived together, so each needs only
what the earlier ranges hold.  No answer is joined back to rows by key.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiplens.operators.schema import quoted
from shiplens.session import stage_table

# Rows a range should hold, the most ranges there are, and the arrival numbers
# sampled per range; all shape the plan only.
ROWS_PER_RANGE = 1_000_000
MAX_RANGES = 50_000
SAMPLED_PER_RANGE = 20


def range_bounds(keys: DataFrame, key: str, rows: int, ranges: int) -> dict[int, int]:
    """Upper bounds of about equal ranges of a long column, with how often each was met as a bound.

    At most about ``SAMPLED_PER_RANGE * ranges`` numbers reach the driver, picked by a hash of the row.
    """
    if ranges < 2:
        return {}
    share = min(1.0, SAMPLED_PER_RANGE * ranges / max(rows, 1))
    row_hash = F.xxhash64(key, F.monotonically_increasing_id()).bitwiseAND(F.lit((1 << 30) - 1))
    sample = np.sort(keys.where(row_hash < F.lit(int(share * (1 << 30)))).select(key).toArrow().column(0).to_numpy())
    if not len(sample):
        return {}
    at = (np.arange(1, ranges) * len(sample)) // ranges
    return dict(Counter(sample[at].tolist()))


def _position(bounds: Column, n: int, key: Column) -> Column:
    """How many of the ``n`` sorted numbers ``bounds`` are below ``key``: binary search as one expression."""
    steps = [1 << b for b in reversed(range(n.bit_length()))]
    below = lambda at: F.coalesce(F.get(bounds, at) < key, F.lit(False))
    return F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda pos, step: pos + F.when(below(pos + step - 1), step).otherwise(0))


def late_events(
    df: DataFrame,
    arrival_col: str,
    ts_col: str = "ts",
    delay_seconds: int = 30,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """Add ``prior_max_ts`` and ``is_late`` to every row.

    ``arrival_col`` must be an integer arrival sequence (offset, line number);
    rows sharing a value arrived together.  A row without one has no earlier
    rows: its ``prior_max_ts`` is null and it isn't late.
    """
    columns = [F.col(quoted(c)) for c in df.columns]
    staged, _ = stage_table(df.withColumn("__k", F.col(quoted(arrival_col)).cast("long")), "arrivals")
    keyed = staged.where("__k is not null")
    n = keyed.count()
    met = range_bounds(keyed, "__k", n, max(1, min(MAX_RANGES, -(-n // rows_per_range))))
    bounds = sorted(met)
    number, pieces = F.lit(0), F.lit(1)
    if bounds:
        # built from text in one call; the optimizer folds it to a literal
        array = lambda xs: F.split(F.lit(",".join(map(str, xs))), ",").cast("array<bigint>")
        keyed = keyed.withColumn("__pos", _position(array(bounds), len(bounds), F.col("__k")))
        # a bound met several times is a number that fills ranges on its own
        fills = F.coalesce(F.get(array(met[b] if met[b] > 1 else 0 for b in bounds), F.col("__pos")), F.lit(0))
        alone = (fills > 0) & (F.get(array(bounds), F.col("__pos")) == F.col("__k"))
        number, pieces = 2 * F.col("__pos") + alone.cast("int"), F.when(alone, fills).otherwise(1)
    piece = F.pmod(F.xxhash64(*columns, F.spark_partition_id()), pieces)
    ranged = keyed.withColumns({"__range": number, "__piece": piece})

    # greatest time of all earlier ranges (one row per range)
    earlier_ranges = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    per_range = ranged.groupBy("__range").agg(F.max(quoted(ts_col)).alias("__max"))
    carried = per_range.select("__range", F.max("__max").over(earlier_ranges).alias("__carried"))

    # greatest time of smaller numbers inside the range
    smaller = Window.partitionBy("__range", "__piece").orderBy("__k").rangeBetween(Window.unboundedPreceding, -1)
    rows = ranged.withColumn("__inside", F.max(quoted(ts_col)).over(smaller)).join(F.broadcast(carried), "__range")
    scanned = rows.select(*columns, F.greatest("__inside", "__carried").alias("prior_max_ts"))
    apart = staged.where("__k is null").select(*columns, F.lit(None).cast(scanned.schema["prior_max_ts"].dataType).alias("prior_max_ts"))
    lag = F.col("prior_max_ts") - F.make_interval(secs=F.lit(delay_seconds))
    return scanned.unionByName(apart).withColumn("is_late", F.coalesce(F.col(quoted(ts_col)) < lag, F.lit(False)))
