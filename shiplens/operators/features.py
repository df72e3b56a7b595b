"""Feature derivation, sampling and splitting (FN-9, FN-10, SMP-1/2, ML-11, ML-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiplens.functions.numeric import LATE_THRESHOLD_DAYS, haversine_km, late_flag
from shiplens.operators.clean import impute_constant
from shiplens.operators.schema import ensure_columns, present, quoted, resolve, split_by_type

# The model's feature list, label and carried identifiers.
SELECTED_FEATURES = [
    "geo_distance_km",
    "order_region",
    "shipping_mode",
    "customer_segment",
    "sales",
    "delivery_days",
    "num_orders",
]
LABEL = "late_delivery_risk"
ID_COLUMNS = ["order_id", "customer_id", "market"]
DELIVERY_ALIASES = ("delivery_days", "days_for_shipping_real")
QUANTITY_ALIASES = ("num_orders", "order_item_quantity")

# Origin and destination columns that a distance is derived from.
COORDINATES = ("origin_latitude", "origin_longitude", "dest_latitude", "dest_longitude")

HEX_DIGITS = 8


def hash_fraction(key: Column, fraction: float) -> Column:
    """True for a stable ``fraction`` of keys: md5 hex prefix below a threshold.

    Unlike ``sample(seed)``, membership depends only on the key, so it is the
    same after repartitioning, retries or in another engine.
    """
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    limit = int(fraction * 16**HEX_DIGITS)
    if limit >= 16**HEX_DIGITS:
        return F.lit(True)
    threshold = format(limit, f"0{HEX_DIGITS}x")
    return F.substring(F.md5(key.cast("string")), 1, HEX_DIGITS) < F.lit(threshold)


def row_key(cols: Sequence[str]) -> Column:
    return F.concat_ws(":", *[F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in cols])


def sample_hash(df: DataFrame, key_cols: Sequence[str], fraction: float) -> DataFrame:
    """Deterministic key-hash sample (SMP-1)."""
    return df.where(hash_fraction(row_key(key_cols), fraction))


def split_hash(df: DataFrame, key_cols: Sequence[str], train_fraction: float = 0.8, col: str = "split") -> DataFrame:
    """Label every row ``train`` or ``test`` by key hash (SMP-2).

    The two parts are disjoint and cover the input whatever the partitioning.
    """
    return df.withColumn(
        col, F.when(hash_fraction(row_key(key_cols), train_fraction), F.lit("train")).otherwise(F.lit("test"))
    )


def add_delivery_features(df: DataFrame, threshold: int = LATE_THRESHOLD_DAYS) -> DataFrame:
    """Derive ``delivery_days``, the late label, distance and quantity if absent.

    The distance is that of the four coordinate columns; without them it is 0.
    """
    src = resolve(df, DELIVERY_ALIASES)
    qty = resolve(df, QUANTITY_ALIASES)
    defaults: dict[str, Column] = {}
    if src is not None:
        defaults["delivery_days"] = F.col(src)
    have_points = all(c in df.columns for c in COORDINATES)
    defaults["geo_distance_km"] = haversine_km(*COORDINATES) if have_points else F.lit(0.0)
    defaults["num_orders"] = F.col(qty) if qty else F.lit(1)
    df = ensure_columns(df, defaults)
    if "delivery_days" in df.columns:
        df = ensure_columns(df, {LABEL: late_flag("delivery_days", threshold)})
    return df


def feature_table(
    df: DataFrame,
    features: Sequence[str] = SELECTED_FEATURES,
    label: str = LABEL,
    ids: Sequence[str] = ID_COLUMNS,
) -> DataFrame:
    """Selected features (those present) with the label and identifiers (ML-11).

    Numeric nulls/NaN become 0 and text nulls ``unknown``, in one projection.
    Column order is the feature order, then label, then identifiers, each once.
    """
    feats = present(df, features)
    cols = present(df, list(feats) + [label] + list(ids))
    out = df.select(*[F.col(quoted(c)) for c in cols])
    return impute_constant(out, cols=feats)


def numeric_and_categorical(df: DataFrame, features: Sequence[str]) -> tuple[list[str], list[str]]:
    return split_by_type(df, present(df, features))
