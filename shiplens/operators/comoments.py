"""Correlations of many columns from mergeable co-moment blocks (AGG-10).

For k columns with missing values every pair has its own rows, so one aggregate
per pair would put k * k aggregates into one plan node.  Here each task keeps, for all
pairs at once, the number of rows where both columns are present, and the
means, squared deviations and co-deviations over those rows: four k by k matrices.
A batch gives them by four matrix products of its values with its presence mask; two sets
merge by the parallel update of means and deviations.  Tasks send one row per
column, so the merge is spread over the columns.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.operators.schema import quoted

# Tasks that scan the input, at most: each sends 4 * 8 * k * k bytes.
MAX_TASKS = 4000


def batch_moments(x: np.ndarray) -> np.ndarray:
    """``(4, k, k)``: pair counts, mean of the row's column, its squared deviation, co-deviation; NaN and infinities are absent."""
    there = np.isfinite(x)
    m = there.astype(float)
    shift = np.where(m.any(0), np.where(there, x, 0).sum(0) / np.maximum(m.sum(0), 1), 0.0)
    z = np.where(there, x - shift, 0.0)
    n = m.T @ m
    s, q, p = z.T @ m, (z * z).T @ m, z.T @ z
    per = np.maximum(n, 1)
    return np.stack([n, s / per + shift[:, None] * (n > 0), q - s * s / per, p - s * s.T / per])


def merged(a: np.ndarray, b: np.ndarray, mean_of_other: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Two sets of moments as one; ``mean_of_other`` holds each set's means of the paired column."""
    n = a[0] + b[0]
    per = np.maximum(n, 1)
    d, d_other = b[1] - a[1], mean_of_other[1] - mean_of_other[0]
    share = a[0] * b[0] / per
    mean = np.where(a[0] == 0, b[1], a[1] + d * b[0] / per)
    both = (a[0] > 0) & (b[0] > 0)
    return np.stack([n, mean, a[2] + b[2] + np.where(both, d * d * share, 0), a[3] + b[3] + np.where(both, d * d_other * share, 0)])


def co_moments(df: DataFrame, cols: Sequence[str]) -> np.ndarray:
    """The four k by k matrices of ``cols`` over all rows, in one scan; k rows of them reach the driver."""
    k = len(cols)
    numbers = df.select(*[F.col(quoted(c)).cast("double").alias(f"c{i}") for i, c in enumerate(cols)]).coalesce(MAX_TASKS)

    def partial(batches):
        total = None
        for b in batches:
            x = np.stack([b.column(i).to_numpy(zero_copy_only=False).astype(float) for i in range(k)], axis=1) if b.num_rows else np.empty((0, k))
            if not len(x):
                continue
            one = batch_moments(x)
            total = one if total is None else merged(total, one, (total[1].T, one[1].T))
        if total is not None:
            # a column's row carries the means of its partners too, so rows merge on their own
            rows = [np.stack([total[0][i], total[1][i], total[2][i], total[3][i], total[1][:, i]]).tobytes() for i in range(k)]
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(k, dtype=np.int32)), pa.array(rows, pa.binary())], names=["i", "m"])

    def together(batches):
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for i, raw in zip(b.column(0).to_pylist(), b.column(1), strict=True):
                m = np.frombuffer(raw.as_buffer()).reshape(5, k)
                if i not in held:
                    held[i] = m
                    continue
                a = held[i]
                own = merged(a[:4], m[:4], (a[4], m[4]))
                n = np.maximum(own[0], 1)
                other = np.where(a[0] == 0, m[4], a[4] + (m[4] - a[4]) * m[0] / n)
                held[i] = np.concatenate([own, other[None]])
        for i, m in held.items():
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([m[:4].tobytes()], pa.binary())], names=["i", "m"])

    rows = numbers.mapInArrow(partial, "i int, m binary").repartition(k, "i").mapInArrow(together, "i int, m binary").toArrow()
    out = np.zeros((4, k, k))
    for i, raw in zip(rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True):
        out[:, i] = np.frombuffer(raw).reshape(4, k)
    return out


def correlations(moments: np.ndarray) -> np.ndarray:
    """Pearson r per pair; NaN where fewer than two rows have both, or one column doesn't vary there."""
    n, _, q, c = moments
    spread = np.sqrt(q * q.T)
    with np.errstate(divide="ignore", invalid="ignore"):
        return np.where((n > 1) & (spread > 0), np.clip(c / spread, -1, 1), np.nan)


def wide_correlation_matrix(df: DataFrame, cols: Sequence[str], digits: int | None = 6) -> DataFrame:
    """(col_a, col_b, r) like :func:`profile.correlation_matrix`, for hundreds of columns; null where r isn't defined.

    Null, NaN and infinite values count as missing.  The result has columns squared rows.
    """
    cols = list(cols)
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "col_a string, col_b string, r double")
    r = correlations(co_moments(df, cols))
    rows = [(a, b, None if np.isnan(r[i, j]) else float(r[i, j])) for i, a in enumerate(cols) for j, b in enumerate(cols)]
    out = spark.createDataFrame(rows, "col_a string, col_b string, r double")
    return out if digits is None else out.withColumn("r", F.round("r", digits))
