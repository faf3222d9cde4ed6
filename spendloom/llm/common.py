"""Helpers the operators share."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import spendloom
from spendloom.session import scratch_path

#: Rows that go to a Python worker at once.  With whole documents of a few kB this is a few MB.
BATCH_ROWS = 1024
ROOT = os.path.dirname(os.path.dirname(os.path.abspath(spendloom.__file__)))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """These columns alone, found by exact name, whatever other columns there are and however they are spelled."""
    columns = df.columns
    plain = df.toDF(*[f"c{i}" for i in range(len(columns))])
    return plain.select(*[F.col(f"c{columns.index(n)}").alias(n) for n in names])


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` doesn't have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, kept in the shared folder until the application ends, so that a lost executor costs no more than one read."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    df.write.parquet(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    return spark.read.schema(df.schema).parquet(path)


def prepare(spark: SparkSession) -> None:
    """Small batches; and workers that start in another folder find the package where the driver has it."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    # What a worker frees goes back to the machine, as workers outlive stages.
    for name, value in (("MALLOC_MMAP_THRESHOLD_", 1 << 20), ("MALLOC_TRIM_THRESHOLD_", 4 << 20)):
        spark.sparkContext.environment.setdefault(name, str(value))
    if ROOT not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [*paths, ROOT]))


def map_batches(df: DataFrame, work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema) -> DataFrame:
    prepare(df.sparkSession)
    return df.mapInArrow(work, schema)


def merged(batches: Iterator[pa.RecordBatch], nbytes: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``nbytes`` at least, so that work per batch pays."""
    held, size = [], 0
    for batch in batches:
        if batch.num_rows:
            held.append(batch)
            size += batch.nbytes
        if size >= nbytes:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held, size = [], 0
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


def learns(key: Column) -> Column:
    """Rows that models may learn from: the others are held out by their id."""
    return F.crc32(key.cast("string").cast("binary")) % 5 != 0


def schema_with(df: DataFrame, *fields: T.StructField) -> T.StructType:
    return T.StructType([*df.schema.fields, *fields])
