"""Numeric column functions (FN-9, FN-10, FN-11, FN-12) and exact money sums."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Earth radius used by the distance feature, in kilometres,
# and the delivery-days threshold above which an order counts as late.
EARTH_RADIUS_KM = 6371.0
LATE_THRESHOLD_DAYS = 5


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def late_flag(days: str | Column, threshold: int = LATE_THRESHOLD_DAYS) -> Column:
    """1 when ``days > threshold``, else 0 (null counts as not late)."""
    return F.when(_col(days) > threshold, F.lit(1)).otherwise(F.lit(0))


def haversine_km(
    lat1: str | Column,
    lon1: str | Column,
    lat2: str | Column,
    lon2: str | Column,
    null_as_zero: bool = True,
    radius_km: float = EARTH_RADIUS_KM,
) -> Column:
    """Great-circle distance as a native expression (stays in codegen).

    The ``asin`` argument is clamped to 1 so rounding never yields NaN.
    With ``null_as_zero`` a missing coordinate gives 0.0, as the original
    Python helper did.
    """
    p1, p2 = F.radians(_col(lat1)), F.radians(_col(lat2))
    dlat = p2 - p1
    dlon = F.radians(_col(lon2)) - F.radians(_col(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dlon / 2), 2)
    root = F.sqrt(a)
    # clamp without least(): least() skips nulls and would turn a missing
    # coordinate into asin(1)
    clamped = F.when(root > 1.0, F.lit(1.0)).otherwise(root)
    dist = F.lit(2.0 * radius_km) * F.asin(clamped)
    if null_as_zero:
        dist = F.coalesce(dist, F.lit(0.0))
    return dist


def coerce_double(c: str | Column) -> Column:
    """Text or number to double; anything that does not parse becomes null."""
    return F.trim(_col(c).cast("string")).try_cast("double")


def coerce_value(c: str | Column) -> Column:
    """Typed-in text as ``struct<whole bigint, number double, text string>`` (FN-12).

    One field is set: ``whole`` for digits with an optional minus sign,
    ``number`` for any other text that reads as a number, else ``text`` with
    the trimmed input as it was.  A null input leaves all three null.
    """
    t = F.trim(_col(c).cast("string"))
    whole = F.when(t.rlike(r"^-?[0-9]+$"), t.try_cast("bigint"))
    number = F.when(whole.isNull(), t.try_cast("double"))
    text = F.when(whole.isNull() & number.isNull(), t)
    return F.struct(whole.alias("whole"), number.alias("number"), text.alias("text"))


# Digits kept behind the point when amounts are summed: far below a cent, so
# a rounding of single amounts can't show in a total.
SUM_SCALE = 10


def money(c: str | Column, scale: int = 2) -> Column:
    """Fixed-point view of an amount."""
    return _col(c).cast(f"decimal({18 if scale <= 2 else 28},{scale})")


# Amounts from here on are summed as doubles: the fixed-point type would overflow.
LARGE = 1e17


def money_sum(c: str | Column, scale: int = SUM_SCALE) -> Column:
    """Sum of an amount with its sub-cent digits, as double; null if there is no amount.

    Amounts below ``LARGE`` are added in fixed point, so the sum doesn't depend
    on their order.  Larger ones, infinities and NaN are added as doubles and
    propagate: a NaN, or infinities of both signs, make the sum NaN.
    """
    x = _col(c)
    ordinary = F.abs(x.cast("double")) < LARGE  # NaN is greater than any number
    fixed = F.sum(F.when(ordinary, money(x, scale))).cast("double")
    rest = F.sum(F.when(~ordinary, x.cast("double")))
    return F.when(rest.isNull(), fixed).otherwise(rest + F.coalesce(fixed, F.lit(0.0)))


def money_mean(c: str | Column) -> Column:
    """Mean of an amount over the values that :func:`money_sum` adds (NaN and infinities too, nulls not)."""
    return F.try_divide(money_sum(c), F.count(_col(c)))


def class_probability(prob_vector: str | Column, index: int = 1) -> Column:
    """Probability of one class from an ML probability vector."""
    from pyspark.ml.functions import vector_to_array

    return vector_to_array(_col(prob_vector)).getItem(index)
