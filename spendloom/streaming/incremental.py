"""Landed pages as a file stream, merged batch by batch into a target.

The target is a folder with one sub-folder per micro-batch, and in it the
contract's partition folders, so that a merge over some days reads those days
alone.  A batch compares itself with all other batches and then overwrites its
own folder, so a batch that is run again after a failure writes the same rows
once.  What a batch rejects, unreadable pages included, goes the same way.

With ``Remember`` the stream's state holds the keys of the last days, and of no
others, so a batch of recent rows doesn't read the target at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from spendloom.contracts import Checked, Contract
from spendloom.operators.joins import all_present
from spendloom.operators.merge import rows_to_insert
from spendloom.operators.rejects import split_unreadable
from spendloom.sources.pages import CORRUPT, page_schema, records_and_faults, records_of, torn_schema
from spendloom.store import kept, kept_apart

BATCH = "load_batch"
#: Below the checkpoint, as it is about the state there: files named ``since=<day>`` and ``early=<day>``.
NOTES = "_remembered"


@dataclass(frozen=True)
class Remember:
    """Keys seen in the last ``days`` days are the stream's state.

    ``day`` is the key column that says which day a row is of.  A row cannot land
    before its day begins, so the state knows every stored key of a day inside the
    window, and a row of such a day goes in if its key is new to the state.  These
    rows meet stored ones instead, by a merge that reads their days:

    - late ones, of days before the window, and rows of days to come;
    - rows of days that an earlier batch had rows of before they began;
    - rows of days not after the stream's first batch, or the newest day stored
      then, if the target already had rows.

    State and lateness go by arrival, ``arrived``: the batch's time if not given, and
    never earlier than in the batch before.  A stream keeps this setting, and its
    number of shuffle partitions, for the life of its checkpoint.
    """

    day: str
    days: int
    arrived: Column | None = None


def landed_pages(
    spark: SparkSession,
    path: str,
    record_path: str,
    record: str,
    multi_line: bool = True,
    files_per_batch: int | None = None,
    keep_corrupt: bool = False,
) -> DataFrame:
    """Records of page files as they arrive; an unreadable record, or page, is a row of its raw text."""
    schema = torn_schema(record_path, record) if keep_corrupt else page_schema(record_path, record)
    reader = spark.readStream.schema(schema).option("multiLine", multi_line)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    pages = reader.json(path)
    return records_and_faults(pages, record_path, record) if keep_corrupt else records_of(pages, record_path)


def read_target(spark: SparkSession, target: str, contract: Contract) -> DataFrame:
    """Rows of all loaded batches, with the batch that brought each."""
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(target)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return contract.empty(spark).withColumn(BATCH, F.lit(None).cast("bigint"))
    schema = contract.schema.add(BATCH, T.LongType())
    return spark.read.schema(schema).parquet(target).select(*contract.names, BATCH)


def merge_new_files(
    records: DataFrame,
    prepare: Callable[[DataFrame], DataFrame | Checked],
    target: str,
    checkpoint: str,
    contract: Contract,
    keys: list[str],
    prune_by: str | None = None,
    rejects: str | None = None,
    remember: Remember | None = None,
) -> StreamingQuery:
    """Process all files not seen before, then stop.

    ``prepare`` turns a batch of records into contract rows, or into a checked
    batch whose faulty rows go to the folder ``rejects``.  With ``remember`` it is
    applied to the stream as well, so that only the keys of good rows are remembered.
    """
    if remember is not None and remember.day not in keys:
        raise ValueError(f"{remember.day} is not a key column")

    def load(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession

        def others() -> DataFrame:
            return read_target(spark, target, contract).filter(F.col(BATCH) != batch_id).select(*contract.names)

        # Several passes read the batch, and its files are parsed once for them.
        # The state's many small files lie apart, or a few tasks would read all records beside them.
        with kept(batch, "landed") if remember is None else kept_apart(batch, "landed", _IS_KEY) as landed:
            new_keys, today = None, None
            if remember is not None:
                new_keys = landed.filter(F.col(_IS_KEY) == 1).select(f"{_KEY}.*")
                landed = landed.filter(F.col(_IS_KEY) == 0)
                # One row for a batch; none where a batch only lets old state go.
                today = landed.select(F.to_date(F.max(_ARRIVED))).first()[0]
                if today is None:
                    return
                landed = landed.select(f"{_RECORD}.*")
            good, bad = landed, None
            if CORRUPT in landed.columns:
                good, bad = split_unreadable(landed)
            checked = prepare(good)
            rows = _good(checked)
            if rejects is not None:
                faulty = [d for d in (bad, checked.bad if isinstance(checked, Checked) else None) if d is not None]
                if faulty:
                    reduce(DataFrame.unionByName, faulty).write.mode("overwrite").parquet(f"{rejects}/{BATCH}={batch_id}")
            with kept(contract.conform(rows), "batch") as whole:
                if remember is None:
                    added = rows_to_insert(others(), whole, keys, prune_by)
                else:
                    inside = _inside(whole, others, checkpoint, remember, today)
                    added = _new_rows(whole, new_keys, inside, others, keys, prune_by)
                new = added.write.mode("overwrite")
                parts = contract.partition_by
                (new.partitionBy(*parts) if parts else new).parquet(f"{target}/{BATCH}={batch_id}")

    stream = records if remember is None else _with_new_keys(records, prepare, contract, keys, remember)
    return (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


_RECORD, _KEY, _IS_KEY, _ARRIVED = "_record", "_key", "_is_key", "_arrived"


def _good(prepared: DataFrame | Checked) -> DataFrame:
    return prepared.good if isinstance(prepared, Checked) else prepared


def _with_new_keys(
    records: DataFrame,
    prepare: Callable[[DataFrame], DataFrame | Checked],
    contract: Contract,
    keys: list[str],
    remember: Remember,
) -> DataFrame:
    """The records, and beside them the keys that the state did not have yet; only the keys are shuffled.

    A day before a row's window is before that of every later batch as well, so the state is never asked about its keys.
    """
    arrived = F.current_timestamp() if remember.arrived is None else remember.arrived
    readable = split_unreadable(records)[0] if CORRUPT in records.columns else records
    good = contract.conform(_good(prepare(readable))).select(*keys).filter(all_present(keys))
    late = F.col(remember.day).cast("date") < F.date_sub(F.to_date(_ARRIVED), remember.days)
    recent = good.withColumn(_ARRIVED, arrived).filter(~F.coalesce(late, F.lit(False)))
    dated = recent.withWatermark(_ARRIVED, f"{remember.days} days")
    first = dated.dropDuplicatesWithinWatermark(keys).select(F.struct(*keys).alias(_KEY), F.lit(1).alias(_IS_KEY), _ARRIVED)
    record = F.struct(*[F.col(f"`{c}`") for c in records.columns]).alias(_RECORD)
    every = records.select(record, F.lit(0).alias(_IS_KEY), arrived.alias(_ARRIVED))
    return every.unionByName(first, allowMissingColumns=True)


def _inside(rows: DataFrame, others: Callable[[], DataFrame], checkpoint: str, remember: Remember, today: dt.date) -> Column:
    """Whether a row's day is one of which the state knows all stored keys.

    What the state cannot know is noted before rows are written, so a batch that is
    run again decides alike.
    """
    spark, day = rows.sparkSession, F.col(remember.day).cast("date")
    notes = _notes(spark, checkpoint)
    since = [n.partition("=")[2] for n in notes if n.startswith("since=")]
    if not since:
        newest = others().select(F.max(day)).first()[0]
        since = ["0001-01-01" if newest is None else max(newest, today).isoformat()]
        _note(spark, checkpoint, f"since={since[0]}")
    # Days to come that the batch has rows of, each once.
    ahead = [str(r[0]) for r in rows.filter(day > F.lit(today)).select(day).distinct().collect()]
    for value in ahead:
        _note(spark, checkpoint, f"early={value}")
    early = {n.partition("=")[2] for n in notes if n.startswith("early=")} & {
        (today - dt.timedelta(days=n)).isoformat() for n in range(remember.days + 1)
    }
    window = day.between(F.lit(today - dt.timedelta(days=remember.days)), F.lit(today))
    known = window & (day > F.lit(since[0]).cast("date"))
    return known & ~F.date_format(day, "yyyy-MM-dd").isin(sorted(early)) if early else known


def _new_rows(
    rows: DataFrame,
    new_keys: DataFrame,
    inside: Column,
    others: Callable[[], DataFrame],
    keys: list[str],
    prune_by: str | None,
) -> DataFrame:
    """Rows to insert: by the state where it knows all keys, else by a merge with what is stored."""
    keyed = all_present(keys)
    told = rows.filter(keyed & inside).join(new_keys, keys, "left_semi").select(*rows.columns)
    told = told.union(rows.filter(~keyed))
    rest = rows.filter(keyed & ~inside)
    return told if rest.isEmpty() else told.union(rows_to_insert(others(), rest, keys, prune_by))


def _notes(spark: SparkSession, checkpoint: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{NOTES}/*")
    return [s.getPath().getName() for s in path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []]


def _note(spark: SparkSession, checkpoint: str, name: str) -> None:
    """An empty file: there or not, never half written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{checkpoint}/{NOTES}/{name}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).create(path, True).close()
