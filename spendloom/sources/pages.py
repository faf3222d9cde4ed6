"""Landed JSON: page envelopes, root arrays and one-document-per-entity files.

``multi_line`` is for files that hold one (possibly indented) response each; a
file is then read by one task, which page sizes keep small.  Pages landed one
per line leave it off, and large files are split.

A record is the unit of rejection.  Pages are parsed with their records' types;
only a page in which that fails is taken apart again, its records as texts that
are parsed one by one, so that a value of another type costs its record and not
the page.  What isn't JSON, or isn't the page that was asked for, stays whole.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.store import landed_once
from spendloom.tallies import Counted, Tally, keep

CORRUPT = "_corrupt_record"
# Text of a record that can't be parsed, beside its fields.
RAW = "_raw_record"

# Takes all rows read, with the corrupt column; may say how many of them it kept as rejects.
Unreadable = Callable[[DataFrame], int | None]


def read_documents(
    spark: SparkSession,
    path: str,
    schema: str,
    multi_line: bool = True,
    keep_corrupt: bool = False,
    unreadable: Unreadable | None = None,
) -> DataFrame:
    """One row per document; also one row per element of a root array.

    Documents that are cut off, or hold a value that is not of its type, have
    their whole text in the corrupt column.  ``unreadable`` is handed those, and
    the others are returned.
    """
    full = f"{schema}, {CORRUPT} string" if keep_corrupt or unreadable else schema
    rows = spark.read.schema(full).option("multiLine", multi_line).json(path)
    return parted(rows, unreadable) if unreadable else rows


def parted(rows: DataFrame, unreadable: Unreadable) -> DataFrame:
    """The parsed rows; the others are handed over.  The input is parsed once for both."""
    seen = Counted(rows, landed=F.count(F.lit(1)), good=F.count_if(F.col(CORRUPT).isNull()))
    landed = landed_once(seen.rows, "landed")
    return _handed_over(landed, unreadable, seen.count("landed"), seen.count("good"))


def _handed_over(landed: DataFrame, unreadable: Unreadable, rows: int, good: int) -> DataFrame:
    rejected = unreadable(landed)
    if rejected is not None:
        keep(Tally("read", rows, good, rejected))
    return landed.filter(F.col(CORRUPT).isNull()).drop(CORRUPT)


def read_array(
    spark: SparkSession, path: str, record: str, multi_line: bool = True, unreadable: Unreadable | None = None
) -> DataFrame:
    """Elements of a root-level array; ``unreadable`` is handed the elements that can't be parsed, or a whole text that isn't an array."""
    if unreadable is None:
        return read_documents(spark, path, record, multi_line)
    counts = {"landed": F.count(F.lit(1)), "good": F.count_if(F.col(CORRUPT).isNull())}
    if not multi_line:
        seen = Counted(_elements_of_lines(spark, path, record), **counts)
        landed = landed_once(seen.rows, "landed")
        return _handed_over(landed, unreadable, seen.count("landed"), seen.count("good"))
    seen = Counted(read_documents(spark, path, record, multi_line, keep_corrupt=True), **counts)
    landed = landed_once(seen.rows, "landed")
    rows, good = seen.count("landed"), seen.count("good")
    if rows > good:
        again = Counted(_torn_elements(landed.filter(F.col(CORRUPT).isNotNull()), record), **counts)
        landed = landed.filter(F.col(CORRUPT).isNull()).unionByName(landed_once(again.rows, "torn"))
        rows, good = good + again.count("landed"), good + again.count("good")
    return _handed_over(landed, unreadable, rows, good)


def _elements_of_lines(spark: SparkSession, path: str, record: str) -> DataFrame:
    """Elements of the lines' arrays, faulty ones as texts.

    The reader would repeat an array's whole text with each of its elements, so
    lines are parsed here, as a field of a page: a fault costs a second look at
    one line.  A line that is an object is a record.
    """
    lines = spark.read.text(path).filter(F.trim(F.translate("value", "\t\r", "  ")) != "")
    page = F.from_json(
        F.concat(F.lit('{"_e":'), F.col("value"), F.lit("}")), torn_schema("_e", record), {"columnNameOfCorruptRecord": CORRUPT}
    )
    texts = F.from_json("value", "array<string>")
    whole = F.array(_unparsed(record, F.col("value")))
    elements = (
        F.when(F.ltrim(F.translate("value", "\t\r", "  ")).startswith("{"), F.array(_parsed(F.col("value"), record)))
        .when(F.col("page")[CORRUPT].isNull() & F.col("page")["_e"].isNotNull(), F.col("page")["_e"])
        .otherwise(F.when(F.size(texts) > 0, F.transform(texts, lambda t: _parsed(t, record))).otherwise(whole))
    )
    paged = lines.withColumn("page", page)
    return paged.select(F.explode(elements).alias("_e")).select("_e.*").withColumnRenamed(RAW, CORRUPT)


def _torn_elements(torn: DataFrame, record: str) -> DataFrame:
    """Elements of arrays in which a value has another type, parsed one by one.

    The reader gives such an array's whole text with each of its elements, so a
    text counts as often as its elements do.
    """
    texts = torn.groupBy(CORRUPT).agg(F.count("*").alias("n")).withColumn("parts", F.from_json(CORRUPT, "array<string>"))
    usable = F.size("parts") > 0
    times = F.when(usable, F.expr("n div size(parts)")).otherwise(F.col("n"))
    whole = F.array(_unparsed(record, F.col(CORRUPT)))
    single = F.transform("parts", lambda t: _parsed(t, record))
    each = texts.select(F.when(usable, single).otherwise(whole).alias("_e"), F.explode(F.sequence(F.lit(1).cast("bigint"), times)))
    return each.select(F.explode("_e").alias("_e")).select("_e.*").withColumnRenamed(RAW, CORRUPT)


def _parsed(text: Column, record: str) -> Column:
    """A record's fields, and its text if that can't be parsed."""
    return F.from_json(text, f"{record}, `{RAW}` string", {"columnNameOfCorruptRecord": RAW})


def _unparsed(record: str, text: Column) -> Column:
    fields = T.StructType.fromDDL(record).fields
    return F.struct(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields], text.alias(RAW))


def page_schema(record_path: str, record: str, context: dict[str, str] | None = None) -> str:
    """Schema of a page: its record array and page-level fields."""
    return f"`{record_path}` array<struct<{record}>>{_carried(context)}"


def torn_schema(record_path: str, record: str, context: dict[str, str] | None = None) -> str:
    """Schema of a page for :func:`records_and_faults`."""
    return f"{page_schema(record_path, f'{record}, `{RAW}` string', context)}, `{CORRUPT}` string"


def _carried(context: dict[str, str] | None) -> str:
    return "".join(f", `{name}` {dtype}" for name, dtype in (context or {}).items())


def read_pages(
    spark: SparkSession,
    path: str,
    record_path: str,
    record: str,
    multi_line: bool = True,
    context: dict[str, str] | None = None,
    unreadable: Unreadable | None = None,
) -> DataFrame:
    """Records of one array of each page, with page-level ``context`` fields beside them.

    Pages without the array, or with an empty one, give no rows.  ``unreadable``
    is handed the records that can't be parsed, and whole pages that can't.
    """
    if unreadable is None:
        pages = read_documents(spark, path, page_schema(record_path, record, context), multi_line)
        return records_of(pages, record_path, tuple(context or ()))
    pages = read_documents(spark, path, torn_schema(record_path, record, context), multi_line)
    return parted(records_and_faults(pages, record_path, record, context), unreadable)


def records_of(pages: DataFrame, record_path: str, context: tuple[str, ...] = ()) -> DataFrame:
    """The same over pages already read, from a batch or a stream."""
    kept = [F.col(f"`{c}`") for c in context]
    return pages.select(*kept, F.explode(F.col(f"`{record_path}`")).alias("_r")).select(*kept, "_r.*")


def records_and_faults(
    pages: DataFrame, record_path: str, record: str, context: dict[str, str] | None = None
) -> DataFrame:
    """Records of pages read with :func:`torn_schema`, and rows whose corrupt column holds a faulty record or page."""
    again = f"`{record_path}` array<string>{_carried(context)}, `{CORRUPT}` string"
    page = F.from_json(CORRUPT, again, {"columnNameOfCorruptRecord": CORRUPT})
    single = F.transform(page[record_path], lambda t: _parsed(t, record))
    parsed, usable = F.col(CORRUPT).isNull(), page[CORRUPT].isNull() & page[record_path].isNotNull()
    whole = F.array(_unparsed(record, F.col(CORRUPT)))
    rows = F.when(parsed, F.col(f"`{record_path}`")).when(usable, single).otherwise(whole)
    carried = [F.when(parsed, F.col(f"`{c}`")).otherwise(page[c]).alias(c) for c in context or ()]
    kept = [F.col(f"`{c}`") for c in context or ()]
    return pages.select(*carried, F.explode(rows).alias("_r")).select(*kept, "_r.*").withColumnRenamed(RAW, CORRUPT)
