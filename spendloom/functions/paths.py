"""Values inside nested documents, resolved against the schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.functions.text import strip_markup

Path = tuple[str | int, ...]


def _walk(df: DataFrame, path: Path) -> tuple[Column, T.DataType]:
    col, dtype = None, df.schema
    for step in path:
        if isinstance(dtype, T.StructType):
            field = dtype[step]
            col = F.col(f"`{step}`") if col is None else col.getField(step)
            dtype = field.dataType
        elif isinstance(dtype, T.MapType):
            col, dtype = F.try_element_at(col, F.lit(step)), dtype.valueType
        elif isinstance(dtype, T.ArrayType):
            col, dtype = F.get(col, F.lit(step)), dtype.elementType
        else:
            raise ValueError(f"{path}: nothing to look up in {dtype.simpleString()}")
    return col, dtype


def _drop_falsy(col: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StringType):
        return F.nullif(col, F.lit(""))
    if isinstance(dtype, T.BooleanType):
        return F.when(col, col)
    if isinstance(dtype, T.NumericType):
        return F.when(col != 0, col)
    if isinstance(dtype, (T.ArrayType, T.MapType)):
        return F.when(F.size(col) > 0, col)
    return col


def path_value(df: DataFrame, path: Path, keep_falsy: bool = False) -> Column:
    """Value at a path of field names, map keys and list positions.

    A missing step gives NULL.  By default 0, false, empty text and empty lists
    count as missing too, unless the last step is a list position.
    """
    col, dtype = _walk(df, path)
    if keep_falsy or (isinstance(path[-1], int) and not isinstance(dtype, T.StringType)):
        return col
    return _drop_falsy(col, dtype)


def path_value_clean(df: DataFrame, path: Path, keep_falsy: bool = False) -> Column:
    """The same as text without line breaks and paragraph tags."""
    cleaned = strip_markup(path_value(df, path, keep_falsy).cast("string"))
    return F.nullif(cleaned, F.lit(""))


def latest_version(df: DataFrame, path: Path) -> tuple[Column, Column]:
    """Value and timestamp of the first entry of a property's version list."""
    first = (*path, "versions", 0)
    return path_value(df, (*first, "value")), path_value(df, (*first, "timestamp"))
