"""Per-column medians and quantiles (AGG-5).

``approx_quantiles`` is one ``approxQuantile`` call over all columns (the
reference looped one job per column).  ``exact_quantiles`` returns the
discrete quantile -- the value of rank ``ceil(q * n)`` among non-null values --
without ever holding a column in one place: each round cuts the remaining
candidate range into bins of equal width, counts rows per bin in one
distributed aggregation (only ``columns x bins`` counts come back), and keeps
the bin that holds the target rank.  A bin that spans a single value ends the
search, so a value repeated in a third of all rows costs one round, not a
huge task.  Rounds needed: about log_bins(n).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.operators.schema import quoted
from shiplens.session import remove_path, stage_table

_INF = float("inf")


def approx_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5, rel_error: float = 0.01) -> dict[str, float | None]:
    """Approximate quantile per column in a single pass."""
    if not cols:
        return {}
    plain = df.select(*[F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(cols)])
    res = plain.approxQuantile(plain.columns, [q], rel_error)
    return {c: (r[0] if r else None) for c, r in zip(cols, res)}


def exact_quantiles(df: DataFrame, cols: Sequence[str], q: float = 0.5, bins: int = 4096) -> dict:
    """Exact discrete quantile per numeric column (null and NaN ignored), in the column's own type.

    The projected columns are written once to Parquet in the shared folder,
    so the rounds re-read their own columns of a written table, and a lost
    executor costs a re-read only.  Each round cuts every column's remaining
    window into ``bins`` equal-width bins and runs one aggregation grouped by
    (column, bin) returning count, min and max -- at most ``columns x bins``
    rows reach the driver.  The bin holding the target rank becomes the next
    window ``[min, max]``; its ends fall into different bins, so the window
    shrinks every round, and a bin holding one distinct value ends the search.

    Values keep their type: whole numbers are binned by exact integer
    arithmetic and decimals as decimals, so a 64-bit value is never rounded.
    Infinite values are ordered ends of their own, counted before the search.
    """
    cols = list(cols)
    if not cols:
        return {}
    found: dict = {}
    kinds = {c: df.schema[c].dataType for c in cols}
    names = {c: f"c{i}" for i, c in enumerate(cols)}
    base, path = stage_table(df.select(*[F.col(quoted(c)).alias(names[c]) for c in cols]), "quantiles")
    try:
        states = _windows(base, cols, names, kinds, q, found)
        while states:
            states = _narrowed(base, names, kinds, states, bins, found)
    finally:
        remove_path(df.sparkSession, path)
    return {c: found[c] for c in cols}


def _is_float(kind: T.DataType) -> bool:
    return isinstance(kind, (T.DoubleType, T.FloatType))


def _windows(base: DataFrame, cols: list[str], names: dict, kinds: dict, q: float, found: dict) -> dict:
    """Rank and first window of each column; columns decided by their ends go to ``found``."""
    aggs = []
    for c in cols:
        v = F.col(names[c])
        inner = F.when(F.abs(v.cast("double")) < _INF, v) if _is_float(kinds[c]) else v
        ends = [(v.cast("double") == F.lit(-_INF)), (v.cast("double") == F.lit(_INF))] if _is_float(kinds[c]) else [F.lit(False)] * 2
        aggs += [
            F.struct(
                F.count(inner).alias("n"), F.min(inner).alias("lo"), F.max(inner).alias("hi"),
                F.count(F.when(ends[0], 1)).alias("low"), F.count(F.when(ends[1], 1)).alias("high"),
            ).alias(names[c])
        ]
    first, states = base.agg(*aggs).first(), {}
    for c in cols:
        s = first[names[c]]
        total = s["low"] + s["n"] + s["high"]
        k = max(1, math.ceil(q * total))
        if not total:
            found[c] = None
        elif k <= s["low"]:
            found[c] = -_INF
        elif k > s["low"] + s["n"]:
            found[c] = _INF
        elif s["lo"] == s["hi"]:
            found[c] = s["lo"]
        else:
            states[c] = {"k": k - s["low"], "lo": s["lo"], "hi": s["hi"], "below": 0}
    return states


def _bin(v: Column, state: dict, kind: T.DataType, bins: int) -> Column:
    """Number of the equal-width bin of ``v`` in the window, in arithmetic that is exact for its type."""
    lo, hi = state["lo"], state["hi"]
    if _is_float(kind):
        # halved before subtracting, so that the width of a window can't overflow
        if hi / 2 == lo / 2:  # two smallest numbers side by side
            return F.when(v == F.lit(lo).cast(kind), 0).otherwise(bins - 1)
        share = (v.cast("double") / 2 - F.lit(lo / 2)) / F.lit(hi / 2 - lo / 2)
        return F.least(F.floor(share * bins).cast("int"), F.lit(bins - 1))
    if isinstance(kind, T.DecimalType):
        share = (v.cast("double") - F.lit(float(lo))) / F.lit(max(float(hi) - float(lo), 5e-324))
        inner = F.greatest(F.lit(1), F.least(F.floor(share * (bins - 2)).cast("int") + 1, F.lit(bins - 2)))
        # the ends have bins of their own, so the window shrinks even where doubles can't tell values apart
        return F.when(v == F.lit(lo).cast(kind), 0).when(v == F.lit(hi).cast(kind), bins - 1).otherwise(inner)
    width = max(1, -(-(hi - lo + 1) // bins))
    wide = "decimal(38,0)"
    return F.floor((v.cast(wide) - F.lit(lo).cast(wide)) / F.lit(width).cast(wide)).cast("int")


def _narrowed(base: DataFrame, names: dict, kinds: dict, states: dict, bins: int, found: dict) -> dict:
    """One round over the columns in ``states``; solved ones go to ``found``."""
    order = list(states)
    groups, inside = [], []
    for i, c in enumerate(order):
        v, s = F.col(names[c]), states[c]
        within = v.between(F.lit(s["lo"]).cast(kinds[c]), F.lit(s["hi"]).cast(kinds[c]))
        if _is_float(kinds[c]):
            within = within & ~F.isnan(v)
        inside.append(within)
        groups += [F.lit(i), F.when(within, _bin(v, s, kinds[c], bins))]
    # rows outside every window are dropped at the scan; stack stays in codegen
    kept = base.where(reduce(lambda a, b: a | b, inside))
    rows = kept.select(F.stack(F.lit(len(order)), *groups).alias("i", "bin"), *[F.col(names[c]) for c in order]).where("bin is not null")
    value = [F.when(F.col("i") == i, F.col(names[c])) for i, c in enumerate(order)]
    ends = [e for i in range(len(order)) for e in (F.min(value[i]).alias(f"lo{i}"), F.max(value[i]).alias(f"hi{i}"))]
    counted = rows.groupBy("i", "bin").agg(F.count(F.lit(1)).alias("n"), *ends).collect()  # at most columns x bins rows
    left = {}
    for i, c in enumerate(order):
        s = states[c]
        at = s["below"]
        for r in sorted((r for r in counted if r["i"] == i), key=lambda r: r["bin"]):
            if at + r["n"] >= s["k"]:
                lo, hi = r[f"lo{i}"], r[f"hi{i}"]
                if lo == hi:
                    found[c] = lo
                else:
                    left[c] = {"k": s["k"], "lo": lo, "hi": hi, "below": at}
                break
            at += r["n"]
    return left
