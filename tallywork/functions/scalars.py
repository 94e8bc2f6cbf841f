"""Numeric and conditional expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def fahrenheit_from_tenths(tenths_celsius: Column) -> Column:
    """Tenths of a degree Celsius to degrees Fahrenheit, two decimals."""
    return F.round(tenths_celsius.cast("double") * 0.1 * 1.8 + 32.0, 2)


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    """The quotient, 0 where the denominator is 0."""
    return F.when(denominator != 0, numerator / denominator).otherwise(F.lit(0.0))


def other_of_pair(first: Column, second: Column, one: object) -> Column:
    """The member of a pair that is not ``one``."""
    return F.when(first == one, second).otherwise(first)


def exact(amount: Column, scale: int = 2) -> Column:
    """A decimal, so that sums do not depend on the order of addition."""
    return amount.cast(f"decimal(18,{scale})")
