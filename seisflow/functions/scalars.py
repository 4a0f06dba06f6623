"""Scalar Column helpers.

All of them return ``Column`` expressions, so they stay inside whole-stage
codegen and Catalyst can fold or push them down.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

__all__ = [
    "col_of", "trunc_int", "ts_text", "shift",
    "round2", "clamp_points", "cap", "linspace", "confidence_label", "ci_regex",
    "zscore", "magnitude_class",
]


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trunc_int(c) -> Column:
    """G1: truncating cast to int (toward zero); NaN/inf → null instead of an ANSI error."""
    c = col_of(c)
    return F.when(F.isnan(c), F.lit(None)).otherwise(c.try_cast("int"))


def magnitude_class(c="magnitude") -> Column:
    """Magnitude class: the truncated integer part, so class 0 covers (-1, 1)."""
    return trunc_int(c)


def ts_text(c) -> Column:
    """Timestamp → ``yyyy-MM-dd HH:mm:ss`` text."""
    return F.date_format(col_of(c), "yyyy-MM-dd HH:mm:ss")


def shift(ts, days: int = 0, hours: int = 0) -> Column:
    """Timestamp arithmetic with an explicit interval (negative = back in time)."""
    return col_of(ts) + F.make_dt_interval(F.lit(days), F.lit(hours), F.lit(0), F.lit(0.0))


def round2(c, digits: int = 2) -> Column:
    """Half-even rounding, as pandas/numpy ``round`` does.

    The value is first snapped to 9 decimals so that a tie (a mean of 212.825)
    is recognised whichever side of it the floating-point sum landed on; the
    result then no longer depends on summation order, i.e. on partitioning.
    """
    return F.bround(F.round(col_of(c), 9), digits)


def clamp_points(count, lo: int = 5, hi: int = 15) -> Column:
    """``min(hi, max(lo, int(count / 2)))``."""
    return F.least(F.lit(hi), F.greatest(F.lit(lo), (col_of(count) / 2).cast("long").cast("int")))


def cap(c, ceiling) -> Column:
    """Cap a prediction at a ceiling (e.g. 1.2 × zone maximum)."""
    return F.least(col_of(c), col_of(ceiling))


def linspace(lo, hi, n) -> Column:
    """Array of ``n`` evenly spaced values from lo to hi inclusive (numpy.linspace):
    ``i * step + lo`` with the last value exactly ``hi``."""
    lo, hi, n = col_of(lo), col_of(hi), col_of(n)
    step = (hi - lo) / (n - 1).cast("double")
    return F.transform(F.sequence(F.lit(0), n - 1),
                       lambda i: F.when(i == n - 1, hi).otherwise(i.cast("double") * step + lo))


def confidence_label(zone_count, pred, zone_max) -> Column:
    """High when the zone has more than 10 events and the prediction is within its maximum."""
    return F.when((col_of(zone_count) > 10) & (col_of(pred) <= col_of(zone_max)), "High").otherwise("Medium")


def ci_regex(c, pattern: str, literal: bool = False) -> Column:
    """Case-insensitive search anywhere in the text; null text → false."""
    c = col_of(c)
    if literal:
        hit = F.lower(c).contains(pattern.lower())
    else:
        hit = c.rlike("(?i)" + pattern)
    return F.coalesce(hit, F.lit(False))


def zscore(c, mean: float, std: float) -> Column:
    """(x - mean) / std with population std; a constant column maps to 0."""
    if mean is None:  # fitted on no rows
        return F.lit(None).cast("double")
    scale = std if std and std > 0 else 1.0
    return (col_of(c) - F.lit(float(mean))) / F.lit(float(scale))
