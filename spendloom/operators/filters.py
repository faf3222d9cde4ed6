"""Row filters with the missing-value rules the loads rely on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.functions.dates import days_before
from spendloom.store import Table


def differs(col: Column, value) -> Column:
    """Unlike the value, or missing."""
    return ~col.eqNullSafe(F.lit(value))


def trailing_window(df: DataFrame, day: str, as_of, days: int, include_today: bool = False) -> DataFrame:
    """Rows of the last ``days`` days; bounds fold to constants, so day partitions are pruned."""
    last = F.col(day) <= days_before(as_of, 0) if include_today else F.col(day) < days_before(as_of, 0)
    return df.filter((F.col(day) >= days_before(as_of, days)) & last)


def largest(source: DataFrame | Table, column: str) -> Column:
    """Largest value of a column, NULL without rows: a scalar subquery, or for a stored table what it knows without reading it."""
    return source.select(F.max(column)).scalar() if isinstance(source, DataFrame) else source.largest(column)


def smallest(source: DataFrame | Table, column: str) -> Column:
    return source.select(F.min(column)).scalar() if isinstance(source, DataFrame) else source.smallest(column)
