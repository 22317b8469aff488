"""Rounding that gives the same digits in every engine with IEEE doubles."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int) -> Column:
    """Half away from zero, computed with plain double arithmetic."""
    scale = float(10**digits)
    number = value.cast("double")
    return F.signum(number) * F.floor(F.abs(number) * scale + 0.5).cast("double") / scale


def ratio(numerator: Column, denominator: Column) -> Column:
    """Double division; NULL where the denominator is zero or missing."""
    return F.try_divide(numerator.cast("double"), denominator.cast("double"))


def share_pct(part: Column, whole: Column) -> Column:
    return ratio(part, whole) * 100.0
