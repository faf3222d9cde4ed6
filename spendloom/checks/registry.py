"""Registration of checked queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.session import tune

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def check(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query, with its SQL where one can express it."""

    def register(query: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(query(tune(spark), sf_dir))

        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLE[name] = sql
        return query

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Types both engines hand over alike: whole numbers as bigint, other decimals as double, days and times as text.

    Up to 15 digits these conversions lose nothing.
    """
    return df.select(*[_plain(f).alias(f.name) for f in df.schema.fields])


def _plain(field: T.StructField):
    col, dtype = F.col(f"`{field.name}`"), field.dataType
    if isinstance(dtype, T.DecimalType):
        return col.cast("bigint" if dtype.scale == 0 else "double")
    if isinstance(dtype, T.IntegerType):
        return col.cast("bigint")
    if isinstance(dtype, T.DateType):
        return col.cast("string")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.date_format(col, "yyyy-MM-dd HH:mm:ss")
    return col


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
