"""CSV reports, positional report rows and stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.sources.pages import CORRUPT, Unreadable
from spendloom.sources.quoted import Quoted
from spendloom.store import landed_once


def read_csv_report(
    spark: SparkSession,
    path: str,
    headers: tuple[str, ...],
    keep_corrupt: bool = False,
    unreadable: Unreadable | None = None,
) -> DataFrame:
    """CSV with a header row, every column as text; files are read in ranges.

    The header is checked against ``headers``, so a report whose columns moved
    fails instead of loading values under the wrong names.  Quoted values may span
    lines.  ``unreadable`` is handed lines with too few or too many values, or a
    stray quote; without it they are taken as far as they go.
    """
    report = Quoted(spark, path, headers)
    loose = report.check_headers()
    corrupt = F.lit(None).cast("string").alias(CORRUPT)
    rows = report.plain()
    if loose:
        lines = landed_once(report.numbered(), "loose")
        runs = landed_once(report.taken(report.runs(lines)), "runs")
        rows = rows.union(runs.select("text"))
    rows = rows.select(report.values(F.col("text")).alias("_v"), corrupt)
    if loose:
        faulty = report.rejected(lines, runs).select(report.values(F.col("text")).alias("_v"), F.col("text").alias(CORRUPT))
        if unreadable:
            unreadable(landed_once(faulty.select("_v.*", CORRUPT), "faulty"))
        else:
            rows = rows.union(faulty)
    return rows.select("_v.*", CORRUPT) if keep_corrupt else rows.select("_v.*")


POSITIONAL_PAGE = "rows array<array<string>>"


def rows_to_columns(pages: DataFrame, names: tuple[str, ...], rows: str = "rows") -> DataFrame:
    """Report matrix to one row per entry with named columns; short rows end in NULLs."""
    entries = pages.select(F.explode(rows).alias("_row"))
    return entries.select(*[F.get("_row", F.lit(i)).alias(n) for i, n in enumerate(names)])


def read_table(spark: SparkSession, table: str, columns: list[str] | None = None) -> DataFrame:
    """Projection of a stored table, by path or by catalog name."""
    df = spark.read.parquet(table) if "/" in table else spark.table(table)
    return df.select(*columns) if columns else df
