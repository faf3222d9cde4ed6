"""Stored tables: Parquet folders that are appended to, merged into, or replaced as a whole.

A table is a folder of version folders.  Spark's job commit leaves a
``_SUCCESS`` file last, so the newest version that has one is the current
content; a replacement that fails half-way is never seen by readers.

A table in buckets writes only what changes into a new version.  Its manifest,
renamed into place last, lists the folders of every bucket, older versions' ones
included: that rename is the switch.  Until then, and for readers that opened the
table before, the old content stands whole.  Rows lie sorted by key, with Bloom
filters of the keys, so that a merge finds the files that hold its batch's keys
without reading the others, and writes these files anew; of a folder that lost
some files the manifest lists the rest.  A bucket in many parts is written whole.

Writers take a version number of their own by creating a file that must be new.
A version follows the one that was current when its writer began, and only one
can: the second of two writers at a time fails, and the first one's rows stay.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import reduce
from operator import and_

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom import tallies
from spendloom.contracts import Checked, Contract
from spendloom.contracts.contract import ERRORS
from spendloom.operators.joins import all_present
from spendloom.session import scratch_path
from spendloom.tallies import Counted

# Folder name Spark gives to rows whose partition column is NULL.
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def written(df: DataFrame, name: str) -> DataFrame:
    """The same rows, computed once and read back from the shared folder."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def dropped(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def kept(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """The same as ``written``, for as long as the block lasts."""
    with kept_apart(df, name) as rows:
        yield rows


@contextmanager
def kept_apart(df: DataFrame, name: str, *by: str) -> Iterator[DataFrame]:
    """The same as ``kept``, in folders by the columns ``by``."""
    path = scratch_path(df.sparkSession, name)
    try:
        (df.write.partitionBy(*by) if by else df.write).parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        dropped(df.sparkSession, path)


# Folders to remove when the innermost load ends.
_loads: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("loads", default=None)


@contextmanager
def load_scratch() -> Iterator[None]:
    """What :func:`landed_once` writes inside the block is removed after it."""
    folders: list[tuple[SparkSession, str]] = []
    token = _loads.set(folders)
    try:
        yield
    finally:
        _loads.reset(token)
        for spark, folder in folders:
            dropped(spark, folder)


def landed_once(df: DataFrame, name: str) -> DataFrame:
    """Parsed input, written so that several readers parse it once; kept until the load, or else the session, ends."""
    spark = df.sparkSession
    path, folders = scratch_path(spark, name), _loads.get()
    if folders is None:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(folder)
    else:
        folders.append((spark, path))
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


MANIFEST, CLAIM, NEXT = "_MANIFEST", "_CLAIM", "_NEXT"
#: Batches of so many keys are looked up in the files' filters.
LOOKUP_KEYS = 1000
#: A bucket in more parts is written whole by the next merge.
MOST_PARTS = 16


class Conflict(RuntimeError):
    """Another writer changed the table meanwhile."""


class Table:
    """``buckets`` matters for contracts with ``bucket_by``: it stays the same for the life
    of a table and should make a bucket a few files, thousands for a large table.
    ``file_rows`` bounds the rows of a file.
    """

    def __init__(self, spark: SparkSession, path: str, contract: Contract, buckets: int = 16, file_rows: int = 1_000_000):
        self.spark = spark
        self.path = path.rstrip("/")
        self.contract = contract
        self.buckets = buckets
        self.file_rows = file_rows

    @property
    def _bucket_column(self) -> str:
        # The count is part of the name: a table opened with another one cannot be merged into.
        return f"bucket_of_{self.buckets}"

    def _bucket(self) -> Column:
        """Bucket of a row's key; rows with a missing key part have one of their own."""
        keys = self.contract.bucket_by
        dtypes = {f.name: f.dtype for f in self.contract.fields}
        hashed = F.xxhash64(*[F.col(k).cast(dtypes[k]) for k in keys])
        number = F.pmod(hashed, F.lit(self.buckets)).cast("int")
        return F.when(all_present(list(keys)), number).otherwise(self.buckets)

    def _committed(self) -> list[int]:
        jvm = self.spark._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        last = MANIFEST if self.contract.bucket_by else "_SUCCESS"
        found = fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/v*/{last}")) or []
        return sorted(int(s.getPath().getParent().getName()[1:]) for s in found)

    def _folder(self, version: int) -> str:
        return f"{self.path}/v{version}"

    def _place(self, name: str):
        """A path below the table, and its file system."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}")
        return path, path.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _new_version(self) -> int:
        """A number that no other writer has, above all there are."""
        taken = [int(n[1:]) for n in self._names(f"{self.path}/v*")]
        version = max(taken, default=0) + 1
        while not self._created(f"v{version}/{CLAIM}"):
            version += 1
        return version

    def _created(self, name: str, content: str = "") -> bool:
        """Whether the file is new; creating it is atomic."""
        path, fs = self._place(name)
        try:
            stream = fs.create(path, False)
        except Py4JJavaError:
            if not fs.exists(path):
                raise
            return False
        stream.write(bytearray(content, "utf-8"))
        stream.close()
        return True

    def exists(self) -> bool:
        return bool(self._committed())

    def read(self) -> DataFrame:
        """Current content; no rows before the first load."""
        versions = self._committed()
        if not versions:
            return self.contract.empty(self.spark)
        if self.contract.bucket_by:
            return self._read_folders([f for folders in self._manifest(versions[-1]).values() for f in folders])
        return self.spark.read.schema(self.contract.schema).parquet(self._folder(versions[-1])).select(*self.contract.names)

    def largest(self, column: str) -> Column:
        """The largest stored value, NULL without one; see :meth:`_extreme`."""
        return self._extreme(column, F.max)

    def smallest(self, column: str) -> Column:
        return self._extreme(column, F.min)

    def _extreme(self, column: str, which: Callable[[str], Column]) -> Column:
        """From folder names for the column that the table is laid out by.

        Of other days, and of floating-point numbers, from the files' statistics: no
        column is read.  Files without statistics, as all their values are missing,
        make it a scalar subquery that reads the one column.
        """
        versions = self._committed()
        dtype = {f.name: f.dtype for f in self.contract.fields}[column]
        if column in self.contract.partition_by or not versions:
            days = self.partitions() if versions else []
            return F.lit((days[-1] if which is F.max else days[0]) if days else None).cast(dtype)
        if self.contract.bucket_by:
            paths = [f"{self.path}/{f}" for folders in self._manifest(versions[-1]).values() for f in folders]
        else:
            paths = [self._folder(versions[-1])]
        if not paths:
            return F.lit(None).cast(dtype)
        try:
            value = _with_statistics(self.spark, self.contract.schema, paths).select(which(column)).first()[0]
        except (Py4JJavaError, PySparkException) as error:
            if "aggregatePushdown" not in str(error):
                raise
            return self.read().select(which(column)).scalar()
        return F.lit(value).cast(dtype)

    def append(self, df: DataFrame) -> None:
        """Add rows to the current version; existing files stay as they are."""
        versions = self._committed()
        if self.contract.bucket_by:
            base = versions[-1] if versions else 0
            before = self._manifest(base, same_layout=True) if versions else {}
            version = self._new_version()
            self._write(df, self._folder(version), "append")
            added = self._buckets_of(version)
            self._switch(version, {b: before.get(b, []) + added.get(b, []) for b in {*before, *added}}, base)
        else:
            # What an unfinished first load left behind is not appended to.
            self._write(df, self._folder(versions[-1] if versions else self._new_version()), "append")

    def append_nonempty(self, df: DataFrame) -> bool:
        """Add rows if there are any; says whether it did."""
        return self.append_counted(df) > 0

    def append_counted(self, df: DataFrame) -> int:
        """The same; says how many rows were added."""
        if df.isEmpty():
            return 0
        seen = Counted(df, n=F.count(F.lit(1)))
        self.append(seen.rows)
        return seen.count("n")

    def replace(self, df: DataFrame) -> None:
        """New content.  ``df`` may read the current version."""
        versions, version = self._committed(), self._new_version()
        self._write(df, self._folder(version), "append")
        if self.contract.bucket_by:
            self._switch(version, self._buckets_of(version), versions[-1] if versions else 0)

    def partitions(self) -> list[str]:
        """Values of the partition column, from the folder names; rows without a value not included."""
        versions = self._committed()
        if not versions:
            return []
        (column,) = self.contract.partition_by
        values = [n.partition("=")[2] for n in self._names(f"{self._folder(versions[-1])}/{column}=*")]
        return sorted(v for v in values if v != NO_VALUE)

    def _read_folders(self, folders: list[str]) -> DataFrame:
        if not folders:
            return self.contract.empty(self.spark)
        paths = [f"{self.path}/{f}" for f in folders]
        return self.spark.read.schema(self.contract.schema).parquet(*paths).select(*self.contract.names)

    def _buckets_of(self, version: int) -> dict[str, list[str]]:
        """Folder of each bucket that a version wrote, relative to the table."""
        names = self._names(f"{self._folder(version)}/{self._bucket_column}=*")
        return {n.partition("=")[2]: [f"v{version}/{n}"] for n in names}

    def _manifest(self, version: int, same_layout: bool = False) -> dict[str, list[str]]:
        """Folders of each bucket; a change of the table asks for ``same_layout``."""
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self._folder(version)}/{MANIFEST}")
        stream = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).open(path)
        try:
            # A folder name for each bucket.
            content = json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        if same_layout and content["layout"] != self._bucket_column:
            raise ValueError(f"{self.path} is laid out as {content['layout']}, not {self._bucket_column}")
        return content["buckets"]

    def _switch(self, version: int, buckets: dict[str, list[str]], base: int) -> None:
        """Make a version the current content, if the one it was made from (0: none) still is."""
        content = json.dumps({"layout": self._bucket_column, "buckets": {b: f for b, f in buckets.items() if f}})
        self._created(f"v{version}/_draft", content)
        (draft, fs), (final, _) = self._place(f"v{version}/_draft"), self._place(f"v{version}/{MANIFEST}")
        if self._committed()[-1:] != [base][: bool(base)]:
            raise Conflict(f"{self.path} is no longer at version {base}")
        following = f"v{base}/{NEXT}" if base else NEXT
        if not self._created(following, str(version)):
            raise Conflict(f"{self.path}: another version follows version {base}; if its writer has stopped, remove {following}")
        if not fs.rename(draft, final):
            raise OSError(f"{final} cannot be put in place")

    def _names(self, pattern: str) -> list[str]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(pattern)
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        return [s.getPath().getName() for s in fs.globStatus(path) or []]

    def replace_partition(self, df: DataFrame, value) -> None:
        """New content of one partition; the others are not read or written."""
        versions = self._committed()
        if not versions:
            return self.append(df)
        (column,) = self.contract.partition_by
        folder = self._folder(versions[-1])
        if df.isEmpty():
            self._drop(f"{folder}/{column}={value}")
        else:
            self._write(df, folder, "overwrite", partitionOverwriteMode="dynamic")

    def merge_into(self, batch: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> None:
        """Rewrite the files that hold the batch's keys as ``merge(their stored rows)``.

        The merge must keep keys as they are.  A bucket that it leaves without rows
        is not listed any more.
        """
        versions = self._committed()
        if not versions:
            return self.replace(merge(self.read()))
        # At most ``buckets`` + 1 numbers.
        touched = [row[0] for row in batch.select(self._bucket()).distinct().collect()]
        if not touched:
            return
        base = versions[-1]
        before, version = self._manifest(base, same_layout=True), self._new_version()
        held = self._holding(batch, {str(b): before.get(str(b), []) for b in touched})
        stored = self._read_folders([f"{folder}/{file}" for folder, files in held.items() for file in files])
        self._write(merge(stored), self._folder(version), "append", touched)
        added = self._buckets_of(version)
        after = {b: self._left(parts, held) if int(b) in touched else parts for b, parts in before.items()}
        self._switch(version, {b: after.get(b, []) + added.get(b, []) for b in {*after, *added}}, base)

    def _holding(self, batch: DataFrame, parts: dict[str, list[str]]) -> dict[str, list[str]]:
        """Files, by folder, of the buckets that have rows of the batch's keys; all files of a bucket in many parts."""
        found: dict[str, set[str]] = {}
        many = [p for listed in parts.values() if len(listed) > MOST_PARTS for p in listed]
        few = [p for listed in parts.values() if len(listed) <= MOST_PARTS for p in listed]
        for part in many:
            folder, file = self._folder_and_file(part)
            found.setdefault(folder, set()).update([file] if file else self._names(f"{self.path}/{folder}/*.parquet"))
        if few:
            for (path,) in self.lookup(batch, few).distinct().collect():  # a row for each file at most
                version, bucket, file = path.split("/")[-3:]
                found.setdefault(f"{version}/{bucket}", set()).add(file)
        return {folder: sorted(files) for folder, files in found.items()}

    def lookup(self, batch: DataFrame, parts: list[str]) -> DataFrame:
        """``file`` of the stored rows, in these parts, that have a key of the batch.

        A few keys are pushed down to the scan, where the files' statistics and
        Bloom filters rule most row groups out; more meet the key columns in a join.
        """
        keys = list(self.contract.bucket_by)
        dtypes = {f.name: f.dtype for f in self.contract.fields}
        wanted = batch.select(*[F.col(k).cast(dtypes[k]).alias(k) for k in keys]).filter(all_present(keys)).distinct()
        rows = self.spark.read.schema(self.contract.schema).parquet(*[f"{self.path}/{p}" for p in parts])
        rows = rows.select(*keys, F.col("_metadata.file_path").alias("file"))
        some = wanted.limit(LOOKUP_KEYS + 1).collect()
        if len(some) > LOOKUP_KEYS:
            return rows.join(wanted, keys, "left_semi").select("file")
        return rows.filter(_any([_all([F.col(k) == F.lit(row[k]).cast(dtypes[k]) for k in keys]) for row in some])).select("file")

    @staticmethod
    def _folder_and_file(part: str) -> tuple[str, str | None]:
        """A part is a bucket's folder in a version, or one file of it."""
        version, bucket, *file = part.split("/")
        return f"{version}/{bucket}", file[0] if file else None

    def _left(self, parts: list[str], held: dict[str, list[str]]) -> list[str]:
        """What stays of a bucket's parts without the files that were rewritten."""
        left = []
        for part in parts:
            folder, file = self._folder_and_file(part)
            gone = held.get(folder, [])
            if file:
                left += [part] if file not in gone else []
            elif gone:
                left += [f"{folder}/{f}" for f in self._names(f"{self.path}/{folder}/*.parquet") if f not in gone]
            else:
                left.append(part)
        return left

    def truncate(self) -> None:
        self.replace(self.contract.empty(self.spark))

    def prune(self, keep: int = 2) -> None:
        """Delete what the newest ``keep`` versions don't read."""
        versions = self._committed()
        if not self.contract.bucket_by:
            for version in versions[:-keep]:
                self._drop(self._folder(version))
            return
        parts = [p for v in versions[-keep:] for listed in self._manifest(v).values() for p in listed]
        used = {self._folder_and_file(p)[0] for p in parts}
        for version in versions[:-keep]:
            self._drop(f"{self._folder(version)}/{MANIFEST}")
            own = [f for folders in self._buckets_of(version).values() for f in folders]
            for folder in own:
                if folder not in used:
                    self._drop(f"{self.path}/{folder}")
            if not used & set(own):
                self._drop(self._folder(version))

    def _drop(self, folder: str) -> None:
        dropped(self.spark, folder)

    def stage(self, batch: Checked, rejects: Table) -> None:
        """Replace the content by a checked batch, and append its rejects if there are any.

        The batch is written as it was checked, so its source is read once.  What
        was checked, stored, rejected and left out is counted on the way.
        """
        landed = Counted(batch.tagged, n=F.count(F.lit(1)), good=F.count_if(F.col(ERRORS) == ""))
        with kept(landed.rows, self.contract.name.lower()) as rows:
            checked = batch.over(rows)
            stored = Counted(checked.good, n=F.count(F.lit(1)))
            self.replace(stored.rows)
            rejected, loaded = rejects.append_counted(checked.bad), stored.count("n")
        outside = landed.count("good") - loaded
        tallies.keep(tallies.Tally(self.contract.name, landed.count("n"), loaded, rejected, outside))

    def _write(
        self, df: DataFrame, folder: str, mode: str, only: list[int] | None = None, **options: str
    ) -> None:
        typed = self.contract.conform(df)
        parts = self.contract.partition_by
        if self.contract.bucket_by:
            number = self._bucket()
            if only is not None:
                stray = F.raise_error(F.lit("row of a bucket that is not rewritten")).cast("int")
                number = F.when(number.isin(only), number).otherwise(stray)
            parts = (self._bucket_column,)
            typed = typed.withColumn(self._bucket_column, number)
        if parts:
            # One day or bucket may hold a large share of the rows: rebalancing
            # splits large ones over tasks and gathers small ones into whole files.
            typed = typed.hint("rebalance", *parts)
        if self.contract.bucket_by:
            typed = typed.sortWithinPartitions(*parts, *self.contract.bucket_by)
            options |= {"maxRecordsPerFile": str(self.file_rows)}
            options |= {f"parquet.bloom.filter.enabled#{k}": "true" for k in self.contract.bucket_by}
        writer = typed.write.mode(mode).options(**options)
        (writer.partitionBy(*parts) if parts else writer).parquet(folder)


def _with_statistics(spark: SparkSession, schema, paths: list[str]) -> DataFrame:
    """Parquet files by the reader to which aggregates can be pushed down."""
    listed = "spark.sql.sources.useV1SourceList"
    before = spark.conf.get(listed)
    spark.conf.set(listed, ",".join(s for s in before.split(",") if s != "parquet"))
    try:
        return spark.read.schema(schema).parquet(*paths)
    finally:
        spark.conf.set(listed, before)


def _any(tests: list[Column]) -> Column:
    """Whether any test holds, as a balanced tree."""
    if not tests:
        return F.lit(False)
    if len(tests) == 1:
        return tests[0]
    half = len(tests) // 2
    return _any(tests[:half]) | _any(tests[half:])


def _all(tests: list[Column]) -> Column:
    return reduce(and_, tests)
