"""Rejected rows and the failure log."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from contextlib import contextmanager
from functools import wraps

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.contracts.contract import MAX_RAW
from spendloom.sources.pages import CORRUPT
from spendloom.store import Table, load_scratch


def as_rejects(df: DataFrame, reason: Column, raw: str, row_nr: str | None = None) -> DataFrame:
    """Rows in the rejects layout; raw text too long for a warehouse's column is marked, and kept."""
    line = F.col(raw)
    return df.select(
        (F.col(row_nr) if row_nr else F.lit(None)).cast("decimal(18,0)").alias("ROW_NR"),
        reason.alias("ERROR_TEXT"),
        (F.char_length(line) > MAX_RAW).alias("TRUNCATED"),
        line.alias("CSV_DATA"),
    )


def split_unreadable(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Parsed rows, and the raw lines the reader could not parse with what it made of them."""
    good = df.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)
    partial = F.to_json(F.struct(*[F.col(f"`{c}`") for c in good.columns]))
    reason = F.concat(F.lit("unreadable, taken as "), partial)
    return good, as_rejects(df.filter(F.col(CORRUPT).isNotNull()), reason, CORRUPT)


def failures(df: DataFrame, when, step, message) -> DataFrame:
    """Failure-log rows from columns of a batch."""
    return df.select(when.cast("timestamp").alias("ETL_DATE"), step.alias("FILE_NAME"), message.alias("ERROR_MSG"))


def unreadable_to(rejects: Table | None) -> Callable[[DataFrame], int]:
    """What becomes of input that the reader could not parse: it is appended to the rejects, or stops a load without any.

    The handler says how many rows it kept.
    """

    def keep(rows: DataFrame) -> int:
        bad = split_unreadable(rows)[1]
        if rejects is not None:
            return rejects.append_counted(bad)
        if not bad.isEmpty():
            raise ValueError("unreadable input, and no table for rejects")
        return 0

    return keep


def logged(step: str) -> Callable[[Callable], Callable]:
    """A load that takes ``log``: a failure is appended to that table before it stops the load.

    What the load parsed once for several readers is removed when it ends.
    """

    def wrap(run: Callable) -> Callable:
        @wraps(run)
        def inner(*args, log: Table | None = None, **options):
            with load_scratch():
                if log is None:
                    return run(*args, **options)
                with logged_step(log, step):
                    return run(*args, **options)

        return inner

    return wrap


@contextmanager
def logged_step(log: Table, step: str):
    """Append a failure of the enclosed load to the log, then let it stop the load."""
    try:
        yield
    except Exception as error:
        spark = log.spark
        row = spark.createDataFrame([(dt.datetime.now(), step, str(error))], "at timestamp, step string, msg string")
        log.append(failures(row, F.col("at"), F.col("step"), F.col("msg")))
        raise
