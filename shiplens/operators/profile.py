"""Table profiling (AGG-3, AGG-4, AGG-10, AGG-11, AGG-12, SCH-7).

Every profile is one aggregation over the table whose output has
O(columns) or O(bins) rows; nothing row-level reaches the driver.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.operators.clean import drop_nulls, is_missing
from shiplens.operators.comoments import wide_correlation_matrix
from shiplens.operators.schema import quoted
from shiplens.session import remove_path, stage_table


# Columns from which correlations come from co-moment blocks.
WIDE = 16


def profile_counts(df: DataFrame) -> DataFrame:
    """Row count and column count (AGG-4)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        "n_rows", F.lit(len(df.columns)).alias("n_columns")
    )


def profile_missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Missing values (null or blank) per column with their ratio (AGG-3).

    One aggregation computes every count; ``stack`` then turns the single wide
    row into (column, n_missing, n_rows, missing_ratio) rows.
    """
    cols = list(cols) if cols is not None else df.columns
    wide = df.agg(
        F.count(F.lit(1)).alias("__n"),
        *[F.sum(F.when(is_missing(df, c), 1).otherwise(0)).alias(f"__m{i}") for i, c in enumerate(cols)],
    )
    pieces = [e for i, c in enumerate(cols) for e in (F.lit(c), F.col(f"__m{i}"))]
    long = wide.select("__n", F.stack(F.lit(len(cols)), *pieces).alias("column_name", "n_missing"))
    return long.select(
        "column_name",
        F.col("n_missing").cast("long").alias("n_missing"),
        F.col("__n").alias("n_rows"),
        F.when(F.col("__n") > 0, F.col("n_missing") / F.col("__n")).alias("missing_ratio"),
    )


def sparse_columns(df: DataFrame, threshold: float = 0.7) -> list[str]:
    """Columns whose missing ratio is strictly above ``threshold``."""
    prof = profile_missing(df).where(F.col("missing_ratio") > threshold).select("column_name")
    return [r[0] for r in prof.collect()]  # at most one row per column


def drop_sparse_columns(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Drop columns whose missing ratio exceeds ``threshold`` (SCH-7)."""
    return df.drop(*sparse_columns(df, threshold))


def correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """Pearson correlation for every column pair, pairwise-complete (AGG-10).

    All pairs in one aggregation up to ``WIDE`` columns, beyond that by
    co-moment blocks (:mod:`comoments`).  NaN and infinities count as
    missing: an infinite value has no finite mean, so it would void every pair
    of its column.  Returned long: (col_a, col_b, r) with the diagonal and both orders, like a matrix.
    """
    cols = list(cols)
    if len(cols) > WIDE:
        return wide_correlation_matrix(df, cols, digits)
    aggs, labels = _pair_correlations(cols)
    wide = df.agg(*aggs)
    pieces = [e for a, b, alias in labels for e in (F.lit(a), F.lit(b), F.col(alias))]
    long = wide.select(F.stack(F.lit(len(labels)), *pieces).alias("col_a", "col_b", "r"))
    r = F.col("r")
    if digits is not None:
        r = F.round(r, digits)
    return long.select("col_a", "col_b", r.alias("r"))


def _pair_correlations(cols: Sequence[str]) -> tuple[list[Column], list[tuple[str, str, str]]]:
    """One ``corr`` per pair, and (col_a, col_b, its name) in both orders."""
    number = {c: F.col(quoted(c)).cast("double") for c in cols}
    clean = {c: F.when(F.abs(number[c]) < float("inf"), number[c]) for c in cols}
    aggs, labels = [], []
    for i, a in enumerate(cols):
        for j, b in enumerate(cols):
            if j < i:
                continue
            aggs.append(F.corr(clean[a], clean[b]).alias(f"__c{i}_{j}"))
            labels.append((a, b, f"__c{i}_{j}"))
            if i != j:
                labels.append((b, a, f"__c{i}_{j}"))
    return aggs, labels


def histogram(df: DataFrame, col: str, bins: int = 30) -> DataFrame:
    """Equal-width histogram over the finite [min, max], last bin closed (AGG-11).

    Two passes: min/max (one row to the driver), then one grouped count with
    the edges as literals.  All ``bins`` rows are present, empty ones with 0:
    the spine is a ``range`` of bin numbers outer-joined to the counts.  Null
    and NaN are left out; an infinite value lies beyond every finite edge and
    counts in the outermost bin on its side.
    """
    data = drop_nulls(df.select(F.col(quoted(col)).cast("double").alias("x")), ["x"])
    finite = F.when(F.abs("x") < float("inf"), F.col("x"))
    b = data.agg(F.min(finite).alias("lo"), F.max(finite).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    spark = df.sparkSession
    if lo is None:
        return spark.createDataFrame([], "bin int, bin_lo double, bin_hi double, n long")
    width = (hi - lo) / bins
    if width > 0:
        inner = F.least(F.floor((F.col("x") - F.lit(lo)) / F.lit(width)).cast("int"), F.lit(bins - 1))
        bin_of = F.when(F.col("x") < F.lit(lo), 0).when(F.col("x") > F.lit(hi), bins - 1).otherwise(inner)
    else:
        bin_of = F.when(F.col("x") > F.lit(hi), bins - 1).otherwise(0)
    counted = data.groupBy(bin_of.alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    spine = spark.range(bins).select(F.col("id").cast("int").alias("bin"))
    return spine.join(counted, "bin", "left").select(
        "bin",
        (F.lit(lo) + F.col("bin") * F.lit(width)).alias("bin_lo"),
        (F.lit(lo) + (F.col("bin") + 1) * F.lit(width)).alias("bin_hi"),
        F.coalesce(F.col("n"), F.lit(0)).cast("long").alias("n"),
    ).orderBy("bin")


def density_curve(df: DataFrame, col: str, points: int = 50, digits: int | None = 12) -> DataFrame:
    """Gaussian kernel density on an even grid over [min, max] (AGG-12).

    Bandwidth by Scott's rule, ``n^(-1/5)`` times the sample standard
    deviation, over the finite values.  Equal values are counted first
    (partial aggregation), and the kernel is summed over the distinct values
    with their counts as weights: exact, and the work per grid point follows
    the number of distinct values, not of rows.
    """
    data = df.select(F.col(quoted(col)).cast("double").alias("x")).where(F.abs("x") < float("inf"))
    counted, path = stage_table(data.groupBy("x").agg(F.count(F.lit(1)).alias("w")), "density-counts")
    try:
        return _weighted_density(data, counted, points, digits)
    finally:
        remove_path(df.sparkSession, path)


def _weighted_density(data: DataFrame, counted: DataFrame, points: int, digits: int | None) -> DataFrame:
    df = data
    st = data.agg(
        F.count(F.lit(1)).alias("n"),
        F.min("x").alias("lo"),
        F.max("x").alias("hi"),
        F.stddev_samp("x").alias("sd"),
    ).first()
    n, lo, hi, sd = st["n"], st["lo"], st["hi"], st["sd"]
    if not n or sd is None or sd == 0:
        return df.sparkSession.createDataFrame([], "point int, x double, density double")
    h = sd * n ** (-1.0 / 5.0)
    step = (hi - lo) / (points - 1)
    grid = [lo + i * step for i in range(points)]
    norm = 1.0 / (n * h * math.sqrt(2.0 * math.pi))
    kernel = lambda g: F.exp(F.lit(-0.5) * F.pow((F.lit(g) - F.col("x")) / F.lit(h), 2))
    sums = counted.agg(*[F.sum(F.col("w") * kernel(g)).alias(f"d{i}") for i, g in enumerate(grid)]).first()
    # one number per grid point came back: the curve is a table of `points` rows
    rows = [(i, g, sums[f"d{i}"] * norm) for i, g in enumerate(grid)]
    curve = df.sparkSession.createDataFrame(rows, "point int, x double, density double")
    return curve if digits is None else curve.withColumn("density", F.round("density", digits))


# Cells of the binned kernel, and its reach in bandwidths.
CELLS, REACH = 4096, 6.0


def binned_density_error(h: float, cell: float) -> float:
    """Most that a density from linear binning with cells of width ``cell`` can be off, for bandwidth ``h``.

    Linear interpolation of the kernel between two cell edges errs by at most
    cell squared / 8 times its greatest second derivative, which is 1 / (h^3 sqrt(2 pi));
    what lies beyond ``REACH`` bandwidths adds less than the kernel there.
    """
    top = 1 / math.sqrt(2 * math.pi)
    return top * (cell * cell / (8 * h**3) + math.exp(-(REACH**2) / 2) / h)


def _cell_sums(x: Column, lo: float, cell: float, cells: int) -> tuple[Column, Column]:
    """Number of the cell of a value, and the share of it that belongs to the cell's upper edge."""
    at = (x - F.lit(lo)) / F.lit(cell)
    number = F.least(F.floor(at), F.lit(cells - 2)).cast("int")
    return number, at - number


def _curve(sums: list[tuple[int, int, float]], n: int, lo: float, hi: float, sd: float, points: int, cells: int) -> list[tuple[int, float, float]]:
    """Density at an even grid from ``(cell, count, upper shares)``; the work follows cells and points, not rows."""
    h, cell = sd * n ** (-1.0 / 5.0), (hi - lo) / (cells - 1)
    weight = np.zeros(cells)
    for number, count, share in sums:
        weight[number] += count - share
        weight[number + 1] += share
    edges = lo + cell * np.arange(cells)
    grid = lo + (hi - lo) / (points - 1) * np.arange(points)
    far = (grid[:, None] - edges[None]) / h
    kernel = np.where(np.abs(far) <= REACH, np.exp(-0.5 * far * far), 0.0)
    values = kernel @ weight / (n * h * math.sqrt(2 * math.pi))
    return [(i, float(g), float(v)) for i, (g, v) in enumerate(zip(grid, values, strict=True))]


def _spread(x: Column) -> list[Column]:
    """Count, ends and deviation of the finite values of a column."""
    finite = F.when(F.abs(x) < float("inf"), x)
    return [F.count(finite).alias("__n"), F.min(finite).alias("__lo"), F.max(finite).alias("__hi"), F.stddev_samp(finite).alias("__sd")]


def binned_density(df: DataFrame, col: str, points: int = 50, cells: int = CELLS, digits: int | None = 9) -> DataFrame:
    """Gaussian kernel density by linear binning (AGG-12): two scans, cost independent of the number of values.

    Each value is split between the two edges of its cell, in proportion to its
    nearness; the kernel then runs over the cell edges within ``REACH``
    bandwidths.  Off by at most :func:`binned_density_error`.
    """
    x = F.col(quoted(col)).cast("double")
    st = df.agg(*_spread(x)).first()
    schema = "point int, x double, density double"
    if not st["__n"] or not st["__sd"]:
        return df.sparkSession.createDataFrame([], schema)
    lo, hi = st["__lo"], st["__hi"]
    number, share = _cell_sums(F.col("x"), lo, (hi - lo) / (cells - 1), cells)
    rows = df.select(x.alias("x")).where(F.abs("x") < float("inf")).select(number.alias("c"), share.alias("f"))
    sums = [tuple(r) for r in rows.groupBy("c").agg(F.count(F.lit(1)), F.sum("f")).collect()]  # a row per cell
    curve = df.sparkSession.createDataFrame(_curve(sums, st["__n"], lo, hi, st["__sd"], points, cells), schema)
    return curve if digits is None else curve.withColumn("density", F.round("density", digits))


def combined_profile(
    df: DataFrame, numeric: Sequence[str] = (), histogram_col: str | None = None, bins: int = 30, points: int = 50, cells: int = CELLS
) -> dict[str, DataFrame]:
    """Counts, missing values, correlations, histogram and density in two scans of ``df`` (JOB-7).

    The first is one aggregation of everything that needs no bounds, the second
    counts histogram bins and density cells together.  More than ``WIDE`` numeric
    columns add a scan for their co-moments.  Results are those of the single functions
    (the density by :func:`binned_density`); each has a row per column, pair, bin or point.
    """
    spark, cols, numeric = df.sparkSession, df.columns, list(numeric)
    aggs, labels = _pair_correlations(numeric) if len(numeric) <= WIDE else ([], [])
    missing = [F.sum(F.when(is_missing(df, c), 1).otherwise(0)).cast("long").alias(f"__m{i}") for i, c in enumerate(cols)]
    x = F.col(quoted(histogram_col)).cast("double") if histogram_col else F.lit(None).cast("double")
    row = df.agg(F.count(F.lit(1)).alias("__rows"), *missing, *aggs, *_spread(x)).first()
    n_rows = row["__rows"]
    out = {
        "counts": spark.createDataFrame([(n_rows, len(cols))], "n_rows long, n_columns int"),
        "missing": spark.createDataFrame(
            [(c, row[f"__m{i}"] or 0, n_rows, (row[f"__m{i}"] or 0) / n_rows if n_rows else None) for i, c in enumerate(cols)],
            "column_name string, n_missing long, n_rows long, missing_ratio double",
        ),
        "correlations": None,
    }
    if labels:
        pairs = [(a, b, row[name]) for a, b, name in labels]
        out["correlations"] = spark.createDataFrame(pairs, "col_a string, col_b string, r double").withColumn("r", F.round("r", 6))
    elif numeric:
        out["correlations"] = wide_correlation_matrix(df, numeric)
    if histogram_col:
        out |= _bins_and_density(df.select(x.alias("x")), row, bins, points, cells)
    return out


def _bins_and_density(data: DataFrame, row, bins: int, points: int, cells: int) -> dict[str, DataFrame]:
    spark, lo, hi = data.sparkSession, row["__lo"], row["__hi"]
    schemas = {"histogram": "bin int, bin_lo double, bin_hi double, n long", "density": "point int, x double, density double"}
    if lo is None:
        return {name: spark.createDataFrame([], kind) for name, kind in schemas.items()}
    width, cell = (hi - lo) / bins, (hi - lo) / (cells - 1)
    x, finite = F.col("x"), F.abs("x") < float("inf")
    number, share = _cell_sums(x, lo, cell, cells) if cell else (F.lit(0), F.lit(0.0))
    bin_of = F.when(x < lo, 0).when(x > hi, bins - 1).otherwise(F.least(F.floor((x - lo) / F.lit(width)).cast("int"), F.lit(bins - 1)) if width else F.lit(0))
    rows = drop_nulls(data, ["x"]).select(bin_of.alias("b"), F.when(finite, number).alias("c"), F.when(finite, share).alias("f"))
    # at most a row for each cell, and one more where a bin ends inside a cell
    sums = rows.groupBy("b", "c").agg(F.count(F.lit(1)).alias("n"), F.sum("f").alias("f")).collect()
    counts = [0] * bins
    for r in sums:
        counts[r["b"]] += r["n"]
    table = [(i, lo + i * width, lo + (i + 1) * width, n) for i, n in enumerate(counts)]
    inside = [(r["c"], r["n"], r["f"]) for r in sums if r["c"] is not None]
    curve = _curve(inside, row["__n"], lo, hi, row["__sd"], points, cells) if row["__sd"] else []
    return {
        "histogram": spark.createDataFrame(table, schemas["histogram"]),
        "density": spark.createDataFrame(curve, schemas["density"]).withColumn("density", F.round("density", 9)),
    }
