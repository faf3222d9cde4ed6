"""Stored columns taken from paths of a nested document."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame

from spendloom.contracts import Contract, Field, text
from spendloom.functions.dates import epoch_ms_local_date, epoch_ms_local_ts, or_text
from spendloom.functions.paths import Path, path_value, path_value_clean

VALUE, KEY, CLEAN, LOCAL_DAY, LOCAL_TIME = "value", "key", "clean", "local day", "local time"


@dataclass(frozen=True)
class Item:
    field: Field
    path: Path
    kind: str = VALUE


@dataclass(frozen=True)
class Options:
    """How document values are read.

    ``tz`` is the zone of local days and times.  ``keep_falsy`` keeps zeros and
    false, which are otherwise missing.  ``mirror`` folds dates before 1970.
    """

    tz: str = "UTC"
    keep_falsy: bool = False
    mirror: bool = False


def at(field: Field, *path: str | int) -> Item:
    return Item(field, path)


def key(field: Field, *path: str | int) -> Item:
    """An id, for which 0 is a value like any other."""
    return Item(field, path, KEY)


def clean(name: str, *path: str | int) -> Item:
    return Item(text(name), path, CLEAN)


def local_day(field: Field, *path: str | int) -> Item:
    return Item(field, path, LOCAL_DAY)


def local_time(name: str, *path: str | int) -> Item:
    """Local time kept as second-precision text."""
    return Item(text(name), path, LOCAL_TIME)


def contract_of(name: str, items: tuple[Item, ...], *more: Field, bucket_by: tuple[str, ...] = ()) -> Contract:
    return Contract(name, (*(i.field for i in items), *more), bucket_by=bucket_by)


def project(df: DataFrame, items: tuple[Item, ...], options: Options = Options()) -> list[Column]:
    """One column per item, in one projection."""
    return [_column(df, item, options).alias(item.field.name) for item in items]


def _column(df: DataFrame, item: Item, options: Options) -> Column:
    if item.kind == CLEAN:
        return path_value_clean(df, item.path, options.keep_falsy)
    value = path_value(df, item.path, options.keep_falsy or item.kind == KEY)
    if item.kind == LOCAL_DAY:
        return or_text(epoch_ms_local_date(value, options.tz, options.mirror), value)
    if item.kind == LOCAL_TIME:
        return epoch_ms_local_ts(value, options.tz, options.mirror)
    return value
