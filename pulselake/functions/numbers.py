"""Rounding that does not depend on the binary form of a double or on summation order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def round_half_up(value: Column, digits: int = 2) -> Column:
    """Round through a decimal; values too large for it have no fraction left to round."""
    exact = F.round(value.try_cast("decimal(28,10)"), digits).cast("double")
    return F.coalesce(exact, value.cast("double"))


def percent(part: Column, whole: Column) -> Column:
    """``part`` of ``whole`` in percent with two decimals, null for an empty whole."""
    return round_half_up(F.try_divide(part, whole) * 100)
