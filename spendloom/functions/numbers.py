"""Numbers read from report text, and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def percent(col: Column) -> Column:
    """``5.25%`` to 0.0525 as ``decimal(18,10)``; text without a number gives NULL."""
    return (F.replace(col, F.lit("%"), F.lit("")).try_cast("decimal(18,8)") / 100).cast("decimal(18,10)")


def micros(col: Column, scale: int = 10) -> Column:
    """Currency millionths to units."""
    return (col.try_cast("decimal(28,4)") / 1_000_000).cast(f"decimal(18,{scale})")


def to_number(col: Column, dtype: str = "decimal(18,0)") -> Column:
    return col.try_cast(dtype)


def fill_zero(df: DataFrame, columns: list[str]) -> DataFrame:
    """Missing metrics become 0."""
    return df.na.fill(0, subset=columns)


def safe_ratio(numerator: Column, denominator: Column, precision: int, scale: int) -> Column:
    """Quotient, 0 when either side is 0; a missing side beside a non-zero one gives NULL."""
    zero = (numerator == 0) | (denominator == 0)
    return F.when(zero, F.lit(0)).otherwise(numerator / denominator).cast(f"decimal({precision},{scale})")
