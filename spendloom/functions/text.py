"""Text cleanup.  Empty text stands for a missing value throughout."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Sentinels used by the web-analytics reports.
NOT_SET = "(not set)"
NO_MEDIUM = "(none)"
DIRECT = "(direct)"

# Entities seen in survey comments and their plain form.
COMMENT_ENTITIES = {"&39;": "", "&#39;": "", "&amp;": "and"}


def blank_to_null(col: Column) -> Column:
    return F.nullif(col, F.lit(""))


def leading(col: Column, n: int) -> Column:
    return F.left(col, F.lit(n))


def trailing(col: Column, n: int) -> Column:
    return F.right(col, F.lit(n))


def trailing_digits(col: Column) -> Column:
    """Id at the end of a URN, whatever its length."""
    return blank_to_null(F.regexp_extract(col, "([0-9]+)$", 1))


def urn(prefix: str, col: Column) -> Column:
    return F.concat(F.lit(prefix), col.cast("string"))


def first_part(col: Column, sep: str) -> Column:
    return F.split_part(col, F.lit(sep), F.lit(1))


def items(col: Column, sep: str = ";") -> Column:
    """Delimited text to a list; empty text is one empty item."""
    return F.split(F.coalesce(col, F.lit("")), f"\\Q{sep}\\E")


def remove(col: Column, token: str) -> Column:
    return F.replace(col, F.lit(token), F.lit(""))


def substitute(col: Column, token: str, value: str) -> Column:
    return F.replace(col, F.lit(token), F.lit(value))


def strip_markup(col: Column) -> Column:
    """Drop line breaks and paragraph tags."""
    return F.regexp_replace(col, "\\n|\\r|<p>", "")


def unescape(col: Column) -> Column:
    for entity, plain in COMMENT_ENTITIES.items():
        col = substitute(col, entity, plain)
    return col
