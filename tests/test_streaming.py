"""Incremental landing: restarts, repeats, retried batches."""

import datetime as dt
import json
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from spendloom.contracts import Contract, day, text, whole
from spendloom.session import scratch_path
from spendloom.streaming import incremental
from spendloom.streaming.incremental import BATCH, Remember, landed_pages, merge_new_files, read_target

ITEMS = Contract("ITEMS", (whole("ID"), text("NAME")))


@pytest.fixture
def stream(spark, tmp_path):
    class Stream:
        incoming = tmp_path / "in"
        target, checkpoint = scratch_path(spark, "target"), scratch_path(spark, "progress")

        def land(self, name, *ids):
            self.incoming.mkdir(exist_ok=True)
            records = [{"id": i, "name": f"{name}{i}"} for i in ids]
            (self.incoming / f"{name}.json").write_text(json.dumps({"data": records}, indent=1))

        def run(self, checkpoint=None, **read):
            records = landed_pages(spark, str(self.incoming), "data", "id bigint, name string", **read)
            prepare = lambda df: df.select(F.col("id").alias("ID"), F.col("name").alias("NAME"))
            query = merge_new_files(records, prepare, self.target, checkpoint or self.checkpoint, ITEMS, ["ID"])
            query.awaitTermination()
            return sorted((int(r.ID) if r.ID is not None else -1, r.NAME, r[BATCH]) for r in read_target(spark, self.target, ITEMS).collect())

    return Stream()


def test_only_new_files_are_processed(stream):
    stream.land("a", 1, 2)
    assert stream.run() == [(1, "a1", 0), (2, "a2", 0)]
    assert stream.run() == [(1, "a1", 0), (2, "a2", 0)]
    stream.land("b", 2, 3)
    assert stream.run() == [(1, "a1", 0), (2, "a2", 0), (3, "b3", 1)]


def test_one_file_per_batch(stream):
    for name in "abc":
        stream.land(name, 1, ord(name))
    got = stream.run(files_per_batch=1)
    assert [i for i, _, _ in got] == [1, 97, 98, 99]
    assert {b for _, _, b in got} == {0, 1, 2}


def test_a_batch_run_again_writes_the_same_rows_once(stream):
    stream.land("a", 1, 2, None)
    first = stream.run()
    # Progress is lost: the same files come again as batch 0.
    assert stream.run(checkpoint=scratch_path_of(stream)) == first


def scratch_path_of(stream):
    return stream.checkpoint + "-lost"


def test_nothing_landed(stream):
    stream.incoming.mkdir()
    assert stream.run() == []


def test_rejects_of_a_batch(spark, stream):
    contract = Contract("ITEMS", (whole("ID"), text("NAME")), partition_by=("NAME",))
    stream.land("a", 1, 2)
    cut = '{"data": [{"id": "3", "name'
    (stream.incoming / "b.json").write_text(cut)
    (stream.incoming / "c.json").write_text('{"data": [{"id": "four", "name": "c"}]}')
    rejects = scratch_path(spark, "rejects")
    records = landed_pages(spark, str(stream.incoming), "data", "id string, name string", keep_corrupt=True)
    prepare = lambda df: contract.enforce(df.select(F.col("id").alias("ID"), F.col("name").alias("NAME")))
    merge_new_files(records, prepare, stream.target, stream.checkpoint, contract, ["ID"], rejects=rejects).awaitTermination()
    assert sorted(r.NAME for r in read_target(spark, stream.target, contract).collect()) == ["a1", "a2"]
    found = spark.read.parquet(rejects).collect()
    assert len(found) == 2 and cut in {r.CSV_DATA for r in found} and {r[BATCH] for r in found} == {0}


DATED = Contract("DATED", (whole("ID"), day("DAY"), text("NAME")), partition_by=("DAY",))
TODAY = dt.date(2024, 5, 20)


@pytest.fixture
def remembering(spark, tmp_path, monkeypatch):
    """A stream whose state holds the keys of ten days; batches arrive on the day they are told to."""

    class Stream:
        incoming = tmp_path / "in"
        target, checkpoint, rejects = (scratch_path(spark, n) for n in ("target", "progress", "rejects"))
        scans = 0
        prepared = staticmethod(lambda df: df.select(F.col("id").alias("ID"), F.col("day").alias("DAY"), F.col("name").alias("NAME")))

        def land(self, name, *rows):
            self.incoming.mkdir(exist_ok=True)
            records = [{"id": i, "day": str(TODAY + dt.timedelta(days=d)) if isinstance(d, int) else d, "name": name} for i, d in rows]
            (self.incoming / f"{name}.json").write_text(json.dumps({"data": records}))

        def run(self, after=0):
            """How often the batches read the target; they arrive ``after`` days from the first day."""
            records = landed_pages(spark, str(self.incoming), "data", "id string, day string, name string", keep_corrupt=True)
            arrived = F.lit(dt.datetime.combine(TODAY + dt.timedelta(days=after), dt.time(12)))
            prepare = lambda df: DATED.enforce(self.prepared(df))
            self.scans = 0
            merge_new_files(
                records, prepare, self.target, self.checkpoint, DATED, ["ID", "DAY"], "DAY", self.rejects, Remember("DAY", 10, arrived)
            ).awaitTermination()
            return self.scans

        def rows(self):
            found = read_target(spark, self.target, DATED).collect()
            return sorted((int(r.ID) if r.ID is not None else -1, (r.DAY - TODAY).days, r.NAME) for r in found)

    stream, read = Stream(), incremental.read_target

    def counted(*args):
        stream.scans += 1
        return read(*args)

    monkeypatch.setattr(incremental, "read_target", counted)
    monkeypatch.setitem(globals(), "read_target", read)
    # State is kept by shuffle partition; a few rows need few of them.
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield stream
    spark.conf.set("spark.sql.shuffle.partitions", partitions)


def test_rows_inside_the_window_do_not_read_the_target(remembering):
    remembering.land("a", (1, 0), (1, 0), (2, -3), (None, 0))
    remembering.run()
    assert remembering.rows() == [(-1, 0, "a"), (1, 0, "a"), (1, 0, "a"), (2, -3, "a")]
    remembering.land("b", (1, 0), (2, 0), (2, -3), (3, -9), (None, 0))
    assert remembering.run(after=1) == 0
    both = [(-1, 0, "a"), (-1, 0, "b"), (1, 0, "a"), (1, 0, "a"), (2, -3, "a"), (2, 0, "b"), (3, -9, "b")]
    assert remembering.rows() == both
    assert remembering.run(after=1) == 0 and remembering.rows() == both


def test_late_rows_meet_stored_ones(remembering):
    remembering.land("a", (1, 0), (2, -30))
    remembering.run()
    # State of the first day is gone by then; its rows are late, and known all the same.
    for after, name in ((25, "b"), (60, "c"), (61, "d")):
        remembering.land(name, (1, 0), (2, -30), (3, after), (4, -30))
        assert remembering.run(after) == 1
    assert remembering.rows() == [(1, 0, "a"), (2, -30, "a"), (3, 25, "b"), (3, 60, "c"), (3, 61, "d"), (4, -30, "b")]


def test_rows_before_their_day(remembering):
    remembering.land("a", (1, 0), (2, 40))
    remembering.run()
    for after, name in ((30, "b"), (41, "c")):
        remembering.land(name, (2, 40), (3, after))
        remembering.run(after)
    assert remembering.rows() == [(1, 0, "a"), (2, 40, "a"), (3, 30, "b"), (3, 41, "c")]


def test_a_target_older_than_the_state(remembering):
    remembering.land("a", (1, 0))
    remembering.run()
    remembering.land("b", (2, -1), (3, 2))
    remembering.run(after=2)
    # The state is lost, and all files come again in one batch, with a new one.
    remembering.checkpoint += "-lost"
    remembering.land("c", (1, 0), (2, -1), (3, 2), (4, 3))
    assert remembering.run(after=3) > 0
    assert {r[:2] for r in remembering.rows()} == {(1, 0), (2, -1), (3, 2), (4, 3)}
    assert sum(r[:2] == (3, 2) for r in remembering.rows()) == 1
    # Days after the state's first batch are its own; earlier ones are looked up.
    remembering.land("d", (5, 4))
    assert remembering.run(after=4) == 0
    remembering.land("e", (4, 3), (5, 4))
    assert remembering.run(after=4) == 1
    assert [r for r in remembering.rows() if r[0] > 3] == [(4, 3, "c"), (5, 4, "d")]


def test_a_batch_that_stops_is_run_again(remembering, monkeypatch):
    remembering.land("a", (1, 0), (2, 0), (2, 30))
    remembering.run()
    remembering.land("b", (2, 0), (3, 1), (3, 1), (4, 40))
    real = incremental.kept

    @contextmanager
    def stopped(df, name):
        with real(df, name) as rows:
            yield rows
        if name == "batch":
            raise OSError("driver lost")

    # The batch's rows are written, and its progress is not.
    monkeypatch.setattr(incremental, "kept", stopped)
    with pytest.raises(Exception, match="driver lost"):
        remembering.run(after=1)
    monkeypatch.setattr(incremental, "kept", real)
    remembering.run(after=1)
    assert remembering.rows() == [(1, 0, "a"), (2, 0, "a"), (2, 30, "a"), (3, 1, "b"), (3, 1, "b"), (4, 40, "b")]


def test_keys_of_faulty_rows_are_not_remembered(spark, remembering):
    remembering.land("a", ("one", 0), (2, "soon"))
    remembering.run()
    assert remembering.rows() == [] and spark.read.parquet(remembering.rejects).count() == 2
    (remembering.incoming / "torn.json").write_text('{"data": [{"id": "2", "day')
    remembering.land("b", (1, 0), (2, 0))
    assert remembering.run() == 0 and remembering.rows() == [(1, 0, "b"), (2, 0, "b")]
    assert spark.read.parquet(remembering.rejects).count() == 3


def test_the_state_holds_keys_of_its_window_alone(spark, remembering):
    remembering.land("a", (1, 0), (2, -10), (3, -11), (4, -300), (5, 3))
    records = landed_pages(spark, str(remembering.incoming), "data", "id string, day string, name string")
    prepare = lambda df: DATED.enforce(remembering.prepared(df))
    arrived = F.lit(dt.datetime.combine(TODAY, dt.time(12)))
    query = merge_new_files(
        records, prepare, remembering.target, remembering.checkpoint, DATED, ["ID", "DAY"], "DAY", remember=Remember("DAY", 10, arrived)
    )
    query.awaitTermination()
    assert max(p["stateOperators"][0]["numRowsTotal"] for p in query.recentProgress) == 3
    remembering.land("b", (1, 0), (2, -10), (3, -11), (4, -300), (5, 3), (6, -11))
    remembering.run()
    assert remembering.rows() == [(1, 0, "a"), (2, -10, "a"), (3, -11, "a"), (4, -300, "a"), (5, 3, "a"), (6, -11, "b")]


def test_records_are_read_apart_from_keys(remembering, monkeypatch):
    """Beside the state's files, of which each counts as a few MB, all records would come to few tasks."""
    remembering.land("a", *((i, -i % 5) for i in range(40)))
    real, folders = incremental.kept_apart, []

    @contextmanager
    def seen(df, name, *by):
        with real(df, name, *by) as rows:
            for alone in ("_key IS NULL", "_record IS NULL"):
                files = rows.where(alone).select(F.input_file_name()).distinct().collect()
                folders.append({f.rsplit("/", 2)[1] for (f,) in files})
            yield rows

    monkeypatch.setattr(incremental, "kept_apart", seen)
    remembering.run()
    assert folders[:2] == [{"_is_key=0"}, {"_is_key=1"}] and len(remembering.rows()) == 40


def test_the_day_is_a_key(spark, remembering):
    remembering.land("a", (1, 0))
    records = landed_pages(spark, str(remembering.incoming), "data", "id string, day string, name string")
    with pytest.raises(ValueError, match="not a key column"):
        merge_new_files(records, remembering.prepared, "t", "c", DATED, ["ID"], remember=Remember("DAY", 1))
