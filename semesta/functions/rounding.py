"""Exact half-up rounding on integers.

``avg`` on a decimal keeps four extra digits and rounds once before ``round`` does it again, and a
double ratio is off at ties. Sums here are kept in integer hundredths and rounded once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hundredths(value: Column) -> Column:
    """A decimal with two places as an integer."""
    return (value * 100).cast("bigint")


def half_up(numerator: Column, denominator: Column) -> Column:
    """Integer ratio of two non-negative numbers, rounded half up; NULL on NULL."""
    return F.call_function("div", numerator * 2 + denominator, denominator * 2)


def percent(part: Column, whole: Column) -> Column:
    """Share in hundredths of a percent, so 12.34 % is 1234."""
    return half_up(part * 10000, whole)


def two_places(value: Column) -> Column:
    """Integer hundredths as a double with two places."""
    return value.cast("double") / F.lit(100.0)
