"""Exact rounding on integers.

Scores travel as integer thousandths (``score_milli``) and the ratios the
analyses report are rounded half-up with integer arithmetic, then divided once.
A single IEEE division of two exact integers gives the same double on every
engine, unlike ``round(avg(double))`` whose last bits depend on summation order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def int_div(top: Column, bottom: Column) -> Column:
    """Exact floor division of non-negative longs (``top div bottom``)."""
    top = top.cast("long")
    bottom = bottom.cast("long")
    return ((top - top % bottom) / bottom).cast("long")


def half_up_ratio(num: Column, den: Column, scale: int) -> Column:
    """round_half_up(num / den * scale) / scale for non-negative integers.

    ``((2 * num * scale + den) div (2 * den)) / scale`` as double; NULL when
    ``den`` is 0 or NULL.
    """
    num = num.cast("long")
    den = den.cast("long")
    q = int_div(F.lit(2) * num * F.lit(scale) + den, F.lit(2) * den)
    return F.when(den > 0, q.cast("double") / F.lit(float(scale)))


def half_up_mean_milli(sum_milli: Column, n: Column) -> Column:
    """Mean of integer thousandths, rounded half-up to 3 decimals, as double."""
    return half_up_ratio(sum_milli, n, 1) / F.lit(1000.0)


def pct_one_decimal(part: Column, whole: Column) -> Column:
    """``round(part / whole * 100, 1)`` half-up; 0.0 when ``whole`` is 0."""
    return F.coalesce(half_up_ratio(part * F.lit(100), whole, 10), F.lit(0.0))


# Score buckets of the generator's distribution report.
BUCKET_LOW = "Low (0.0-0.3)"
BUCKET_MEDIUM = "Medium (0.3-0.6)"
BUCKET_HIGH = "High (0.6-1.0)"


def risk_bucket(score_milli: Column) -> Column:
    return (
        F.when(score_milli < 300, F.lit(BUCKET_LOW))
        .when(score_milli < 600, F.lit(BUCKET_MEDIUM))
        .otherwise(F.lit(BUCKET_HIGH))
    )
