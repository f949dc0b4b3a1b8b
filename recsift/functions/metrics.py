"""Scalar metric and report expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def safe_ratio(num: Column, den: Column, default: float = 0.0) -> Column:
    """num / den, ``default`` when den is 0 or NULL."""
    return F.coalesce(F.try_divide(num.cast("double"), den.cast("double")), F.lit(default))


def harmonic_mean(p: Column, r: Column) -> Column:
    """F1 = 2PR / (P + R), 0 when both are 0."""
    return safe_ratio(2.0 * p * r, p + r)


def r6(c: Column, digits: int = 6) -> Column:
    """Round a double for reports (both engines round the same way)."""
    return F.round(c.cast("double"), digits)


def two_digits(c: Column) -> Column:
    """X11: a number as text with two digits; NULL stays NULL."""
    return F.when(c.isNotNull(), F.format_string("%.2f", F.round(c.cast("double"), 2)))


def percent(part: Column, whole: Column) -> Column:
    """X11: ``part`` of ``whole`` as text in percent; NULL for a whole of 0."""
    return F.concat(two_digits(100.0 * F.try_divide(part.cast("double"), whole.cast("double"))), F.lit(" %"))
