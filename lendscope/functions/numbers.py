"""Rounding, ratios and means that do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOUBLE = "double"


def half_up(value: Column, digits: int) -> Column:
    """Round a DOUBLE half away from zero.

    A value such as 2.675 is stored a little below the half; the nudge of 1e-9
    puts it back, so the result equals decimal half-up rounding.
    """
    x = value.cast(DOUBLE)
    return F.round(x + F.signum(x) * F.lit(1e-9), digits)


def money(value: Column) -> Column:
    """Decimal amount as DOUBLE for output; sums before it stay DECIMAL."""
    return value.cast(DOUBLE)


def ratio(numerator: Column, denominator: Column) -> Column:
    """``numerator / denominator`` in DOUBLE; NULL when the denominator is 0."""
    return numerator.cast(DOUBLE) / F.nullif(denominator.cast(DOUBLE), F.lit(0.0))


def percent(numerator: Column, denominator: Column, digits: int) -> Column:
    return half_up(ratio(numerator, denominator) * 100.0, digits)


def mean(column: str | Column) -> Column:
    """Aggregate: exact decimal or integer sum over count, divided once.

    Partial sums of DOUBLE depend on how rows were split over tasks; partial
    sums of DECIMAL or BIGINT do not.
    """
    col = F.col(column) if isinstance(column, str) else column
    return ratio(F.sum(col), F.count(col))


def count_if(condition: Column) -> Column:
    """Aggregate: rows where ``condition`` is true (0 on none)."""
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, column: str | Column) -> Column:
    """Aggregate: sum where ``condition`` is true (NULL on none)."""
    col = F.col(column) if isinstance(column, str) else column
    return F.sum(F.when(condition, col))
