"""Imputation and value cleaning (FN-7, FN-8, FN-12, FLT-3/4/5, SCH-7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiplens.operators.quantiles import approx_quantiles, exact_quantiles
from shiplens.operators.schema import quoted, split_by_type

UNKNOWN = "unknown"


def is_missing(df: DataFrame, c: str, blank_is_missing: bool = True) -> Column:
    """Null, or (for text) blank after trimming.

    Only text columns get the blank test: a number, date or boolean never
    formats to blank text, so casting it to a string on every row would
    change no answer and only cost time.
    """
    col = F.col(quoted(c))
    cond = col.isNull()
    if blank_is_missing and isinstance(df.schema[c].dataType, (T.StringType, T.CharType, T.VarcharType)):
        cond = cond | (F.trim(col) == F.lit(""))
    return cond


def impute_constant(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    numeric_value: float = 0,
    text_value: str = UNKNOWN,
) -> DataFrame:
    """Numeric null/NaN → ``numeric_value``; text null → ``text_value``.

    Blanks in text columns are kept, as in the original job.  One projection.
    """
    cols = list(cols) if cols is not None else df.columns
    numeric, other = split_by_type(df, cols)
    text = [c for c in other if isinstance(df.schema[c].dataType, T.StringType)]

    def fill(c: str) -> Column:
        col = F.col(quoted(c))
        if c in numeric:
            bad = col.isNull()
            if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
                bad = bad | F.isnan(col)
            return F.when(bad, F.lit(numeric_value).cast(df.schema[c].dataType)).otherwise(col).alias(c)
        if c in text:
            return F.coalesce(col, F.lit(text_value)).alias(c)
        return col

    return df.select(*[fill(c) for c in df.columns])


def column_medians(df: DataFrame, cols: Sequence[str], exact: bool = False, rel_error: float = 0.01) -> dict:
    """Median per column: approximate (default) or exact discrete median."""
    if exact:
        return exact_quantiles(df, cols, 0.5)
    return approx_quantiles(df, cols, 0.5, rel_error)


def impute_median(
    df: DataFrame,
    cols: Sequence[str] | None = None,
    exact: bool = False,
    rel_error: float = 0.01,
    text_value: str = UNKNOWN,
) -> DataFrame:
    """Numeric nulls → column median; text nulls → ``text_value`` (FN-8).

    The medians are O(columns) scalars computed in one pass (approximate) or a
    few passes (exact).  As with ``na.fill``, a fractional median filling an
    integer column is truncated toward zero.
    """
    cols = list(cols) if cols is not None else df.columns
    numeric, other = split_by_type(df, cols)
    text = [c for c in other if isinstance(df.schema[c].dataType, T.StringType)]
    medians = column_medians(df, numeric, exact=exact, rel_error=rel_error)

    def fill(c: str) -> Column:
        col = F.col(quoted(c))
        if c in numeric and medians.get(c) is not None:
            m = F.lit(medians[c]).cast(df.schema[c].dataType)
            bad = col.isNull()
            if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
                bad = bad | F.isnan(col)
            return F.when(bad, m).otherwise(col).alias(c)
        if c in text:
            return F.coalesce(col, F.lit(text_value)).alias(c)
        return col

    return df.select(*[fill(c) for c in df.columns])


def drop_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every listed column is present, NaN counting as absent (FLT-5)."""
    kinds = {c: df.schema[c].dataType for c in cols}
    for c in cols:
        there = F.col(quoted(c)).isNotNull()
        df = df.where(there & ~F.isnan(quoted(c)) if isinstance(kinds[c], (T.DoubleType, T.FloatType)) else there)
    return df
