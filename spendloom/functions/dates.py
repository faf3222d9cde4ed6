"""Epoch, report and calendar dates.

None of these depends on the session time zone: UTC days come from day
arithmetic, and local times are computed as wall-clock (zone-free) timestamps.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

SECONDS_PER_DAY = 86_400
MILLIS_PER_DAY = 86_400_000


def _long(col: Column) -> Column:
    return col.try_cast("bigint")


def or_text(converted: Column, source: Column) -> Column:
    """A converted value as text, or the source's own text if it does not convert, for a contract to judge."""
    return F.coalesce(converted.cast("string"), source.cast("string"))


def epoch_s_date(col: Column) -> Column:
    """UTC day of epoch seconds."""
    return F.date_from_unix_date(F.floor(_long(col) / SECONDS_PER_DAY).try_cast("int"))


def epoch_ms_date(col: Column) -> Column:
    """UTC day of epoch milliseconds; text that is no number gives NULL."""
    return F.date_from_unix_date(F.floor(_long(col) / MILLIS_PER_DAY).try_cast("int"))


def epoch_ms_ts(col: Column) -> Column:
    """Instant of epoch milliseconds."""
    return F.timestamp_millis(_long(col))


def _local_wall(col: Column, tz: str, mirror: bool) -> Column:
    millis = F.abs(_long(col)) if mirror else _long(col)
    utc = F.timestamp_add("SECOND", F.floor(millis / 1000), F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"))
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def epoch_ms_local_date(col: Column, tz: str, mirror: bool = False) -> Column:
    """Local day, ``yyyy-MM-dd``.  ``mirror`` folds dates before 1970 forward."""
    return _local_wall(col, tz, mirror).cast("date").cast("string")


def epoch_ms_local_ts(col: Column, tz: str, mirror: bool = False) -> Column:
    """Local time, ``yyyy-MM-dd HH:mm:ss``."""
    return _local_wall(col, tz, mirror).cast("string")


def report_date(col: Column) -> Column:
    """``yyyyMMdd`` dimension value to a date."""
    return F.try_to_date(col, "yyyyMMdd")


def date_from_parts(year: Column, month: Column, day: Column) -> Column:
    """Date from numeric parts; NULL if a part is missing or out of range."""
    return F.concat(year.cast("string"), F.lit("-"), month.cast("string"), F.lit("-"), day.cast("string")).try_cast(
        "date"
    )


def days_before(as_of: Column | dt.date | str, days: int) -> Column:
    """The day ``days`` before the load day."""
    anchor = as_of if isinstance(as_of, Column) else F.lit(str(as_of)).cast("date")
    return F.date_sub(anchor, days)


def window_start_parts(as_of: Column | dt.date | str, days: int) -> dict[str, Column]:
    """Start of a trailing window as calendar parts and epoch seconds."""
    start = days_before(as_of, days)
    return {
        "start_day": start,
        "start_year": F.year(start),
        "start_month": F.month(start),
        "start_dom": F.dayofmonth(start),
        "start_epoch": F.unix_date(start).cast("bigint") * SECONDS_PER_DAY,
    }
