"""Value mappings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.operators.joins import spread_key
from spendloom.operators.merge import unique_rows

# Marketing campaign ids and the program each belongs to.
CAMPAIGN_PROGRAMS = {
    "15cc12bb-009b-4874-aa24-c73417225558": "MSIS",
    "93d7e13b-73f7-4c8c-a196-f7bbf4ae0e0b": "BAPS",
    "b8820d37-72ac-42d9-bf3e-08e4168873cd": "MCJ",
}
DEFAULT_PROGRAM = "CU Online"

# Channel keys and their display names.
CHANNEL_NAMES = {
    "GooglePlusPage": "Google Plus",
    "FacebookPage": "Facebook",
    "LinkedInCompanyPage": "LinkedIn",
}

# Spellings of program names, which differ per platform.
PROGRAM_SPELLINGS = {
    "Google Adwords": {"Master Criminal Justice MCJ": "MCJ", "MC J": "MCJ"},
    "LinkedIn": {
        "Master Criminal Justice MCJ": "MCJ",
        "MC J": "MCJ",
        "CUON": "CU Online",
        "CU Online": "CU Online",
    },
    "Facebook": {"CUON": "CU Online", "Master Criminal Justice MCJ": "MCJ", "M CJ": "MCJ"},
}


def map_values(col: Column, mapping: dict[str, str], default: Column) -> Column:
    """Small constant mapping; a missing value takes the default."""
    out = None
    for key, value in mapping.items():
        out = F.when(col == key, value) if out is None else out.when(col == key, value)
    return default if out is None else out.otherwise(default)


def lookup(df: DataFrame, column: str, table: DataFrame, key: str, value: str, default: Column) -> DataFrame:
    """The same mapping kept in a table; Spark picks the join by its size.

    A key that the table has twice fails the job.  Rows without a key spread over all tasks.
    """
    dim = unique_rows(table.select(F.col(key).cast("string").alias("_k"), F.col(value).alias("_v")), ["_k"])
    spread = spread_key(F.col(column).cast("string"), *[F.col(f"`{c}`") for c in df.columns])
    joined = df.withColumn("_key", spread).join(dim, F.col("_key") == F.concat(F.lit("+"), F.col("_k")), "left")
    mapped = F.when(F.col("_k").isNotNull(), F.col("_v")).otherwise(default)
    return joined.withColumn(column, mapped).drop("_key", "_k", "_v")


def campaign_program(col: Column) -> Column:
    return map_values(col, CAMPAIGN_PROGRAMS, F.lit(DEFAULT_PROGRAM))


def channel_name(col: Column) -> Column:
    return map_values(col, CHANNEL_NAMES, col)


def program_name(col: Column, platform: str) -> Column:
    return map_values(col, PROGRAM_SPELLINGS[platform], col)
