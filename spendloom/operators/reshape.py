"""Projection, flattening, exploding and unions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.contracts import Contract
from spendloom.functions.text import blank_to_null, items


def select_renamed(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """Source columns under their target names, in the order given."""
    return df.select(*[F.col(f"`{source}`").alias(target) for source, target in names.items()])


def load_stamp(df: DataFrame, column: str, as_of=None) -> DataFrame:
    """Load day; without ``as_of`` the day the job runs."""
    return df.withColumn(column, F.current_date() if as_of is None else F.lit(str(as_of)).cast("date"))


def null_columns(df: DataFrame, columns: dict[str, T.DataType]) -> DataFrame:
    """Placeholders for columns the source no longer has."""
    return df.withColumns({name: F.lit(None).cast(dtype) for name, dtype in columns.items()})


def flatten(df: DataFrame, sep: str = ".") -> DataFrame:
    """Nested objects to one column per leaf, named by its path; lists stay lists."""
    return df.select(*[col.alias(sep.join(path)) for path, col in _leaves(df.schema, (), None)])


def _leaves(schema: T.StructType, path: tuple[str, ...], parent: Column | None):
    for field in schema.fields:
        col = F.col(f"`{field.name}`") if parent is None else parent.getField(field.name)
        if isinstance(field.dataType, T.StructType):
            yield from _leaves(field.dataType, (*path, field.name), col)
        else:
            yield (*path, field.name), col


def explode_items(df: DataFrame, keys: list[str], column: str, alias: str, sep: str = ";") -> DataFrame:
    """One row per delimited item with its keys; no items give one row with NULL."""
    exploded = df.select(*keys, F.explode(items(F.col(column), sep)).alias(alias))
    return exploded.withColumn(alias, blank_to_null(F.col(alias)))


def explode_children(df: DataFrame, keys: list[Column], children: Column, alias: str) -> DataFrame:
    """One row per nested child with its parent's keys; no children give no row."""
    return df.select(*keys, F.explode(children).alias(alias))


def union_branches(contract: Contract, branches: list[DataFrame]) -> DataFrame:
    """UNION ALL of branches brought to one column list; absent columns are typed NULLs."""
    return reduce(DataFrame.unionByName, [contract.conform(b) for b in branches])
