"""Join helpers: a broadcast only behind a size check.

Static broadcast from file sizes is off (see ``session.py``); a side is
broadcast either because AQE measured its shuffle output, or because this
check proved it small before the plan was built.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiplens.operators.schema import quoted

# Rows and bytes (as JSON text) a dimension may hold and still be broadcast to
# every executor.  They choose the join strategy only, never the result.
MAX_BROADCAST_ROWS = 100_000
MAX_BROADCAST_BYTES = 32 << 20


def is_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> bool:
    """Whether ``df`` stays within both bounds; reads at most ``max_rows + 1`` rows."""
    size = F.length(F.to_json(F.struct(*[F.col(quoted(c)) for c in df.columns])))
    row = df.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(size), F.lit(0)).alias("b")).first()
    return row["n"] <= max_rows and row["b"] <= max_bytes


def small_side(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint when it is small (:func:`is_small`).

    The check reads a limited number of rows, so it stays cheap when the side
    turns out to be large.  Beyond the bounds the frame is returned unhinted
    and the join stays a shuffled join, which AQE may still turn into a
    broadcast from measured sizes.
    """
    return F.broadcast(df) if is_small(df, max_rows, max_bytes) else df
