"""Stored tables."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from spendloom import session, store
from spendloom.contracts import Contract, day, text, whole
from spendloom.operators.merge import highwater_prune, replace_by_key
from spendloom.session import scratch_path
from spendloom.store import Table

ITEMS = Contract("ITEMS", (whole("ID"), text("NAME")))
DAYS = Contract("DAYS", (whole("ID"), day("AD_DATE")), partition_by=("AD_DATE",))


@pytest.fixture
def items(spark):
    return Table(spark, scratch_path(spark, "items"), ITEMS)


@pytest.fixture
def days(spark):
    return Table(spark, scratch_path(spark, "days"), DAYS)


def rows(make, *ids):
    return make([(i, f"n{i}") for i in ids], "ID int, NAME string")


def ids(table):
    return sorted(int(r.ID) for r in table.read().collect())


def test_empty_before_the_first_load(items):
    assert not items.exists()
    assert items.read().schema == ITEMS.schema
    assert ids(items) == []


def test_append_and_replace(items, make):
    items.append(rows(make, 1))
    items.append(rows(make, 2))
    assert ids(items) == [1, 2]
    items.replace(rows(make, 3))
    assert ids(items) == [3]
    items.append(rows(make, 4))
    assert ids(items) == [3, 4]
    items.truncate()
    assert items.exists() and ids(items) == []


def test_replacement_may_read_the_current_content(items, make):
    items.replace(rows(make, 1, 2, 3))
    items.replace(items.read().filter(F.col("ID") > 1))
    assert ids(items) == [2, 3]


def test_failed_replacement_is_not_seen(items, make):
    items.replace(rows(make, 1))
    broken = rows(make, 2).withColumn("NAME", F.raise_error(F.lit("stop")).cast("string"))
    with pytest.raises(Exception, match="stop"):
        items.replace(broken)
    assert ids(items) == [1]
    items.replace(rows(make, 5))
    assert ids(items) == [5]


def test_prune_keeps_the_newest(items, make):
    for i in range(4):
        items.replace(rows(make, i))
    items.prune(keep=2)
    assert items._committed() == [3, 4]
    assert ids(items) == [3]


def test_append_nonempty(items, make):
    assert not items.append_nonempty(rows(make, 1).limit(0))
    assert not items.exists()
    assert items.append_nonempty(rows(make, 1))


def test_columns_are_bound_by_name(items, make):
    items.replace(make([("a", 1, True)], "NAME string, ID int, OTHER boolean"))
    assert [tuple(r) for r in items.read().collect()] == [(1, "a")]


def by_day(make, *rows):
    return make([(i, d and dt.date(2018, 1, d)) for i, d in rows], "ID int, AD_DATE date")


def content(table):
    return sorted((int(r.ID), r.AD_DATE and r.AD_DATE.day) for r in table.read().collect())


def test_one_partition_is_replaced(days, make):
    days.append(by_day(make, (1, 1), (2, 2), (3, 2)))
    days.replace_partition(by_day(make, (9, 2)), dt.date(2018, 1, 2))
    assert content(days) == [(1, 1), (9, 2)]


def test_a_partition_may_become_empty(days, make):
    days.append(by_day(make, (1, 1), (2, 2)))
    days.replace_partition(by_day(make, (9, 2)).limit(0), dt.date(2018, 1, 2))
    assert content(days) == [(1, 1)]


def test_first_load_without_rows(days, make):
    days.append(by_day(make, (1, 1)).limit(0))
    assert content(days) == [] and days.partitions() == []
    days.append(by_day(make, (1, 1), (2, None)))
    assert days.partitions() == ["2018-01-01"]
    assert days.read().count() == 2


def test_rows_without_a_day(days, make):
    days.append(by_day(make, (1, None), (2, 2)))
    assert [(int(r.ID), r.AD_DATE is None) for r in days.read().orderBy("ID").collect()] == [(1, True), (2, False)]


KEYED = Contract("KEYED", (whole("ID"), text("NAME")), bucket_by=("ID",))


@pytest.fixture
def keyed(spark):
    return Table(spark, scratch_path(spark, "keyed"), KEYED, buckets=8)


def upsert(table, make, *rows):
    batch = make(list(rows), "ID int, NAME string")
    table.merge_into(batch, lambda stored: replace_by_key(stored, batch, ["ID"]))
    return sorted((r.ID is not None and int(r.ID), r.NAME) for r in table.read().collect())


def files(table):
    return {r[0] for r in table.read().select("_metadata.file_path").distinct().collect()}


def test_merge_rewrites_only_the_buckets_of_the_batch(keyed, make):
    keyed.replace(rows(make, *range(40)))
    before = files(keyed)
    got = upsert(keyed, make, (3, "new"), (3, "more"), (99, "added"))
    assert got == sorted([(i, f"n{i}") for i in range(40) if i != 3] + [(3, "more"), (3, "new"), (99, "added")])
    assert len(before & files(keyed)) >= 6


def test_merge_of_missing_keys_loses_nothing(keyed, make):
    assert upsert(keyed, make, (None, "a"), (1, "b")) == [(False, "a"), (1, "b")]
    assert upsert(keyed, make, (2, "c")) == [(False, "a"), (1, "b"), (2, "c")]
    assert upsert(keyed, make, (None, "d")) == [(False, "a"), (False, "d"), (1, "b"), (2, "c")]


def test_merge_into_a_table_without_rows(keyed, make):
    keyed.truncate()
    assert upsert(keyed, make, (1, "a"), (2, "b")) == [(1, "a"), (2, "b")]
    assert upsert(keyed, make, (2, "c")) == [(1, "a"), (2, "c")]


def test_merge_of_nothing(keyed, make):
    keyed.replace(rows(make, 1))
    batch = rows(make, 1).limit(0)
    keyed.merge_into(batch, lambda stored: stored)
    assert ids(keyed) == [1]


def test_merge_may_empty_a_bucket(keyed, make):
    keyed.replace(rows(make, 1, 2, 3))
    keyed.merge_into(rows(make, 2), lambda stored: stored.filter(F.col("ID") != 2))
    assert ids(keyed) == [1, 3]
    keyed.merge_into(rows(make, 1, 3), lambda stored: stored.filter(F.lit(False)))
    assert ids(keyed) == []
    assert upsert(keyed, make, (1, "again")) == [(1, "again")]


def test_a_row_outside_the_rewritten_buckets_fails(keyed, make):
    keyed.replace(rows(make, *range(40)))
    with pytest.raises(Exception, match="not rewritten"):
        keyed.merge_into(rows(make, 3), lambda stored: rows(make, *range(40)))
    assert ids(keyed) == list(range(40))


def test_another_bucket_count_is_noticed(spark, keyed, make):
    keyed.replace(rows(make, 1))
    other = Table(spark, keyed.path, KEYED, buckets=4)
    assert ids(other) == [1]
    with pytest.raises(ValueError, match="not bucket_of_4"):
        other.merge_into(rows(make, 1), lambda stored: stored)


def test_scratch_folder_comes_from_the_session(spark, monkeypatch):
    class Conf:
        def __init__(self, value):
            self.value = value

        def get(self, key, default):
            assert key == "spark.checkpoint.dir"
            return self.value

    class Fake:
        class sparkContext:
            master = "spark://somewhere"
            applicationId = "app"

    fake = Fake()
    fake.conf = Conf("/shared/work/")
    assert session.scratch_root(fake) == "/shared/work"
    fake.conf = Conf(None)
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.scratch_root(fake)
    assert session.scratch_path(spark, "a") != session.scratch_path(spark, "a")


# --- rewrites that stop half-way --------------------------------------------------------


class Stopped(Exception):
    pass


@pytest.mark.parametrize("step", ["_write", "_switch", "_buckets_of"])
def test_a_merge_that_stops_leaves_the_old_content(keyed, make, monkeypatch, step):
    keyed.replace(rows(make, *range(30)))
    opened = keyed.read()
    whole = getattr(Table, step)

    def stop(self, *args, **options):
        if step == "_write":
            whole(self, *args, **options)
        raise Stopped

    change = lambda stored: stored.filter(F.col("ID") != 3).unionByName(rows(make, 3))
    with monkeypatch.context() as m:
        m.setattr(Table, step, stop)
        with pytest.raises(Stopped):
            keyed.merge_into(rows(make, 3), change)
    assert ids(keyed) == list(range(30))
    keyed.merge_into(rows(make, 3), change)
    assert ids(keyed) == list(range(30))
    assert opened.count() == 30


def test_a_reader_opened_before_a_merge_still_works(keyed, make):
    keyed.replace(rows(make, 1, 2, 3))
    opened = keyed.read()
    keyed.merge_into(rows(make, 2), lambda stored: stored.filter(F.col("ID") != 2))
    assert sorted(r.ID for r in opened.collect()) == [1, 2, 3]
    assert ids(keyed) == [1, 3]


def test_untouched_buckets_are_listed_not_copied(keyed, make):
    keyed.replace(rows(make, *range(40)))
    keyed.merge_into(rows(make, 3), lambda stored: stored)
    written_now = keyed._buckets_of(keyed._committed()[-1])
    assert len(written_now) == 1 and ids(keyed) == list(range(40))
    keyed.prune(keep=1)
    assert ids(keyed) == list(range(40))


def test_append_to_a_table_in_buckets(keyed, make):
    keyed.append(rows(make, 1, 2))
    keyed.append(rows(make, 1, 3))
    assert ids(keyed) == [1, 1, 2, 3]
    keyed.merge_into(rows(make, 1), lambda stored: stored.filter(F.col("ID") != 1))
    assert ids(keyed) == [2, 3]


# --- files of a bucket ------------------------------------------------------------------


@pytest.fixture
def many(spark):
    """40 000 rows in 4 buckets, in files of 500 rows."""
    table = Table(spark, scratch_path(spark, "many"), KEYED, buckets=4, file_rows=500)
    table.replace(spark.range(40_000).selectExpr("id AS ID", "concat('n', id) AS NAME"))
    return table


def scanned(df):
    """Rows that the plan's scan gives."""
    df.collect()
    leaf = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_rows_read_follow_the_batch(many, make):
    parts = [p for listed in many._manifest(many._committed()[-1]).values() for p in listed]
    read = {}
    for n in (1, 5, 20):
        batch = make([(i * 1009, "x") for i in range(n)], "ID int, NAME string")
        read[n] = scanned(many.lookup(batch, parts))
        assert many.lookup(batch, parts).distinct().count() <= n
    assert 0 < read[1] <= 1000 and read[5] <= 5 * 1000 and read[20] <= 20 * 1000
    assert scanned(many.lookup(make([(50_000, "x"), (-3, "y")], "ID int, NAME string"), parts)) <= 500


def test_merge_rewrites_only_the_files_of_the_batch(many, make):
    before = files(many)
    got = upsert(many, make, (17, "new"), (39_999, "more"), (40_000, "added"))
    assert len(got) == 40_001 and {(17, "new"), (39_999, "more"), (40_000, "added")} <= set(got)
    assert len(before - files(many)) == 2 and len(before) > 80
    # Files of a bucket that lost some are found and rewritten like folders.
    upsert(many, make, (17, "newer"), (18, "b"))
    got = dict(upsert(many, make, (40_000, "again"), (39_999, "more2")))
    assert got[17] == "newer" and got[18] == "b" and got[40_000] == "again" and got[39_999] == "more2" and len(got) == 40_001
    many.prune(keep=1)
    assert dict(upsert(many, make, (16, "c")))[17] == "newer"


def test_a_batch_of_many_keys(many, make, monkeypatch):
    monkeypatch.setattr(store, "LOOKUP_KEYS", 3)
    got = dict(upsert(many, make, *[(i, "new") for i in range(0, 40_000, 4000)]))
    assert [i for i, name in sorted(got.items()) if name == "new"] == list(range(0, 40_000, 4000)) and len(got) == 40_000


def test_a_bucket_in_many_parts_is_written_whole(keyed, make, monkeypatch):
    monkeypatch.setattr(store, "MOST_PARTS", 3)
    for i in range(40):
        keyed.append(rows(make, i))
    upsert(keyed, make, *[(i, "last") for i in range(100, 140)])
    listed = keyed._manifest(keyed._committed()[-1])
    assert all(len(parts) <= 4 for parts in listed.values())
    assert len(keyed.read().collect()) == 80


# --- two writers ------------------------------------------------------------------------


@pytest.mark.parametrize("first", ["merge", "append", "replace"])
def test_the_second_of_two_writers_fails(spark, keyed, make, first):
    keyed.replace(rows(make, *range(30)))
    other = Table(spark, keyed.path, KEYED, buckets=8)

    def meanwhile(stored):
        if first == "merge":
            other.merge_into(rows(make, 5), lambda s: s.filter(F.col("ID") != 5))
        elif first == "append":
            other.append(rows(make, 50))
        else:
            other.replace(rows(make, 7))
        return stored.filter(F.col("ID") != 3).unionByName(rows(make, 3))

    with pytest.raises(store.Conflict):
        keyed.merge_into(rows(make, 3), meanwhile)
    want = {"merge": [i for i in range(30) if i != 5], "append": [*range(30), 50], "replace": [7]}[first]
    assert ids(keyed) == ids(other) == want
    keyed.merge_into(rows(make, 3), lambda stored: stored.unionByName(rows(make, 3)) if first == "replace" else stored)
    assert ids(keyed) == sorted({*want, 3})


def test_a_version_number_is_taken_once(keyed, make):
    keyed.replace(rows(make, 1))
    assert keyed._new_version() != keyed._new_version()
    # What the writers that stopped left behind is not seen.
    keyed.append(rows(make, 2))
    assert ids(keyed) == [1, 2]


def test_two_writers_at_the_switch(keyed, make):
    """Both have seen the same current version; only one file can name the next."""
    keyed.replace(rows(make, 1))
    base = keyed._committed()[-1]
    assert keyed._created(f"v{base}/{store.NEXT}")
    with pytest.raises(store.Conflict, match="remove"):
        keyed.append(rows(make, 2))
    assert ids(keyed) == [1]


# --- largest and smallest values --------------------------------------------------------

MARKS = (whole("ID"), day("AD_DATE"), day("SEEN"))


@pytest.mark.parametrize("layout", [{}, {"bucket_by": ("ID",)}, {"partition_by": ("AD_DATE",)}])
def test_extremes_come_from_statistics(spark, make, layout):
    table = Table(spark, scratch_path(spark, "marks"), Contract("MARKS", MARKS, **layout), buckets=4)
    none = spark.range(1).select(table.largest("AD_DATE"), table.smallest("SEEN")).first()
    assert tuple(none) == (None, None)
    days = [dt.date(2018, 1, n) for n in range(1, 29)]
    table.replace(make([(i, d, None if i % 2 else d) for i, d in enumerate(days)] + [(99, None, None)], "ID int, AD_DATE date, SEEN date"))
    df = spark.range(1).select(
        table.largest("AD_DATE").alias("a"), table.smallest("AD_DATE").alias("b"), table.largest("SEEN").alias("c"), table.largest("ID").alias("d")
    )
    assert tuple(df.first()) == (days[-1], days[0], days[-2], 99)
    # Read at once, or for files without a value as a subquery.
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert ("struct<SEEN:date>" in plan) == ("partition_by" in layout) and "max(AD_DATE" not in plan


def test_statistics_instead_of_a_column(spark, make):
    table = Table(spark, scratch_path(spark, "marks"), Contract("MARKS", MARKS))
    table.replace(make([(1, dt.date(2018, 1, 1), None)], "ID int, AD_DATE date, SEEN date"))
    paths = [table._folder(table._committed()[-1])]
    plan = store._with_statistics(spark, table.contract.schema, paths).select(F.max("AD_DATE"))._jdf.queryExecution().executedPlan()
    assert "PushedAggregation: [MAX(AD_DATE)]" in plan.toString() and "struct<AD_DATE:date>" not in plan.toString()
    # Other readers are as they were.
    assert "BatchScan" not in table.read()._jdf.queryExecution().executedPlan().toString()
    assert spark.range(1).select(table.largest("SEEN")).first()[0] is None


def test_highwater_mark_of_a_table(days, make):
    staged = by_day(make, (1, 1), (2, 2), (3, None))
    assert highwater_prune(staged, "AD_DATE", days, "AD_DATE").count() == 3
    days.append(by_day(make, (7, 2)))
    assert sorted(r.ID for r in highwater_prune(staged, "AD_DATE", days, "AD_DATE").collect()) == [2, 3]
