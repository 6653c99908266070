"""Scalar helpers with the reference's rounding and null behaviour."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def half_even(c, scale: int = 0) -> Column:
    """pandas ``round``: half to even (``F.round`` is half up)."""
    return F.bround(_c(c), scale)


def r6(c) -> Column:
    """Round a computed double to 6 places for stable value hashes."""
    return F.round(_c(c).cast("double"), 6)


def safe_div(num, den, when_zero=None) -> Column:
    """Division that gives ``when_zero`` (default null) on a zero divisor.

    ANSI mode raises on division by zero, so guard it explicitly.
    """
    num, den = _c(num), _c(den)
    out = F.try_divide(num, den)
    if when_zero is not None:
        out = F.when(den == 0, F.lit(when_zero)).otherwise(out)
    return out


def guarded_ratio(pred, actual, eps: float = 1e-6) -> Column:
    """``pred / (actual + eps)`` when actual > 0 else 0."""
    pred, actual = _c(pred), _c(actual)
    return F.when(actual > 0, pred / (actual + F.lit(eps))).otherwise(F.lit(0.0))
