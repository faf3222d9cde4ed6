"""Test tables written as landed files, for the loads to read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Contract
from spendloom.contracts.tables import ERROR_TABLE
from spendloom.session import scratch_path
from spendloom.store import Table

# Pages are written one per line.
LINES = {"multi_line": False}
#: Records of a compressed file.
FILE_RECORDS = 250_000
#: Lines of a report file.
FILE_LINES = 250_000


def land_pages(df: DataFrame, record_path: str, name: str, context: tuple[str, ...] = ()) -> str:
    """One page per row, holding that row as its only record."""
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns if c not in context])
    return land_documents(df.select(*context, F.array(record).alias(record_path)), name)


def land_texts(df: DataFrame, page: str, text: str, record_path: str | None, name: str) -> str:
    """Pages, or root arrays, of the records, given as JSON texts, that have the same number."""
    records = F.array_join(F.sort_array(F.collect_list(text)), ",")
    start, end = (f'{{"{record_path}":[', "]}") if record_path else ("[", "]")
    pages = df.groupBy(page).agg(F.concat(F.lit(start), records, F.lit(end)).alias("value"))
    path = scratch_path(df.sparkSession, name)
    pages.select("value").write.text(path)
    return path


def land_with_faults(sent: DataFrame, key: str, word: str, record_path: str | None, name: str) -> str:
    """Pages of up to a hundred records; in each, record 42 has a text as its id."""
    record = F.to_json(F.struct(*[F.col(f"`{c}`") for c in sent.columns if c != key]))
    fault = F.replace(record, F.concat(F.lit('"id":'), F.col(key)), F.concat(F.lit(f'"id":"{word} '), F.col(key), F.lit('"')))
    texts = sent.select(
        F.floor(F.col(key) / 100).alias("page"), F.when(F.col(key) % 100 == 42, fault).otherwise(record).alias("text")
    )
    return land_texts(texts, "page", "text", record_path, name)


def land_documents(df: DataFrame, name: str) -> str:
    """One document per line, in compressed files, which can't be split and so are bounded in rows."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).json(path)
    return path


def land_arrays(df: DataFrame, name: str) -> str:
    """One root-level array per line."""
    path = scratch_path(df.sparkSession, name)
    record = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    df.select(F.to_json(F.array(record)).alias("value")).write.text(path)
    return path


def land_csv(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.option("header", True).option("escape", '"').csv(path)
    return path


def new_table(spark: SparkSession, contract: Contract, content: DataFrame | None = None) -> Table:
    """A stored table of its own, empty or with a first load."""
    stored = Table(spark, scratch_path(spark, contract.name.lower()), contract)
    if content is not None:
        stored.replace(content)
    return stored


def new_rejects(spark: SparkSession) -> Table:
    return new_table(spark, ERROR_TABLE)


def as_text(df: DataFrame) -> DataFrame:
    """All columns as the text a source would send."""
    return df.select(*[F.col(f"`{c}`").cast("string").alias(c) for c in df.columns])


def land_csv_lines(df: DataFrame, text: Column, name: str, files: int = 4) -> str:
    """Files of a header line and lines that are texts of rows; a text may be no proper line.

    There are so many more files that each is of about ``FILE_LINES`` lines, and a task sorts a few at most.
    """
    files = max(files, -(-df.count() // FILE_LINES))
    header = ",".join(df.columns)
    lines = df.select(F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(files)).alias("file"), F.lit(1).alias("place"), text.alias("value"))
    heads = df.sparkSession.range(files).select(F.col("id").alias("file"), F.lit(0).alias("place"), F.lit(header).alias("value"))
    path = scratch_path(df.sparkSession, name)
    ordered = lines.union(heads).repartition(files, "file").sortWithinPartitions("file", "place")
    ordered.select("file", "value").write.partitionBy("file").text(path)
    return path
