"""Contracts: types, lengths, order, rejects."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendloom.contracts import Contract, day, money, text, whole
from spendloom.contracts import tables
from spendloom.operators import rejects
from spendloom.session import scratch_path
from spendloom.sources.pages import read_documents
from spendloom.sources.tabular import read_csv_report
from spendloom.store import Table

PEOPLE = Contract("PEOPLE", (whole("ID"), text("NAME", 4), day("BORN"), money("PAID")))


def check(make, *rows):
    return PEOPLE.enforce(make(list(rows), "PAID string, NAME string, BORN string, ID string, EXTRA int"))


def test_good_rows_are_typed_and_ordered_by_name(make):
    good = check(make, ("1.005", "Ann", "2018-1-5", "7", 1)).good
    assert good.columns == PEOPLE.names
    assert tuple(good.first()) == (Decimal(7), "Ann", dt.date(2018, 1, 5), Decimal("1.01"))
    assert good.schema == PEOPLE.schema


def test_empty_text_is_missing(make):
    assert tuple(check(make, ("", "", "", "", 1)).good.first()) == (None, None, None, None)


@pytest.mark.parametrize(
    "row, error",
    [
        (("x", "Ann", None, "1", 1), "PAID: not a decimal(18,2)"),
        (("1", "Annie", None, "1", 1), "NAME: longer than 4"),
        (("1", "Ann", "2018-02-30", "1", 1), "BORN: not a date"),
        (("1", "Ann", None, "1234567890123456789", 1), "ID: not a decimal(18,0)"),
        (("x", "Annie", None, "1", 1), "NAME: longer than 4; PAID: not a decimal(18,2)"),
    ],
)
def test_faulty_rows_are_rejected_with_every_reason(make, row, error):
    batch = check(make, row)
    assert batch.good.count() == 0
    (bad,) = batch.bad.collect()
    assert bad.ERROR_TEXT == error
    assert '"EXTRA":1' in bad.CSV_DATA


def test_every_row_is_good_or_bad(make):
    rows = [(p, n, b, i, 0) for p in ("1", "x") for n in ("Ann", "Annie") for b in ("2018-01-01", "never") for i in ("1", None)]
    batch = check(make, *rows)
    assert (batch.good.count(), batch.bad.count()) == (2, len(rows) - 2)


def test_length_is_counted_in_characters(make):
    assert check(make, (None, "éééé", None, None, 1)).good.count() == 1


def test_absent_columns_become_typed_nulls(make):
    good = PEOPLE.enforce(make([("1",)], "ID string")).good
    assert tuple(good.first()) == (Decimal(1), None, None, None)


def test_row_number_goes_with_the_reject(make):
    bad = PEOPLE.enforce(make([(41, "x")], "line bigint, PAID string"), row_nr="line").bad
    assert bad.first().ROW_NR == Decimal(41)


@pytest.mark.parametrize("rows, faulty", [([("1", "Ann")], 0), ([("x", "Ann"), ("1", "Ann"), ("y", "B")], 2), ([], 0)])
def test_staging_writes_rejects_only_when_there_are_any(spark, make, rows, faulty):
    staged = Table(spark, scratch_path(spark, "people"), PEOPLE)
    log = Table(spark, scratch_path(spark, "rejects"), tables.ERROR_TABLE)
    staged.stage(PEOPLE.enforce(make(rows, "PAID string, NAME string")), log)
    assert staged.read().count() == len(rows) - faulty
    assert log.exists() == bool(faulty)
    assert log.read().count() == faulty


def test_rejects_are_kept_when_no_row_can_be_good(spark, make):
    staged = Table(spark, scratch_path(spark, "people"), PEOPLE)
    log = Table(spark, scratch_path(spark, "rejects"), tables.ERROR_TABLE)
    batch = PEOPLE.enforce(make([("x",), ("1",)], "PAID string"))
    staged.stage(batch.map_good(lambda good: good.filter(F.lit(False))), log)
    assert (staged.read().count(), log.read().count()) == (0, 1)


def test_all_tables_are_well_formed():
    for group in (tables.PRODUCTION, tables.STAGING, tables.WAREHOUSE):
        for contract in group:
            assert len(set(contract.names)) == len(contract.names)
            assert set(contract.partition_by) <= set(contract.names)
    widths = {c.name: len(c.fields) for c in (*tables.PRODUCTION, *tables.WAREHOUSE)}
    assert widths == {
        "GOOGLE_ADWORDS": 23,
        "FACEBOOK_ADS": 29,
        "LINKEDIN_ADS": 25,
        "ASK_NICELY_RESPONSES": 6,
        "HUBSPOT_SOCIAL_POSTS": 11,
        "HUBSPOT_CONTACTS": 29,
        "ERROR_TABLE": 4,
        "ONLINE_STATUS": 24,
        "ONLINE_STATUS_1718": 3,
        "GRADS1718": 9,
        "COGNOS_COURSE_LISTS": 15,
        "COGNOS_COURSE_LISTS_PRD": 16,
    }
    assert len(tables.STG_FACEBOOK_ADS_0818.fields) == 21
    assert len(tables.STG_LINKEDIN_CAMPAIGNS_UPDATED.fields) == 11


def test_unreadable_json_lines(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1}\n{"id": 2, \nnonsense\n')
    read = read_documents(spark, str(tmp_path), "id bigint", multi_line=False, keep_corrupt=True)
    good, bad = rejects.split_unreadable(read)
    assert [r.id for r in good.collect()] == [1]
    assert sorted(r.CSV_DATA for r in bad.collect()) == ["nonsense", '{"id": 2, ']


def test_unreadable_csv_lines(spark, tmp_path):
    (tmp_path / "a.csv").write_text("a,b\n1,2\n3\n4,5,6\n")
    read = read_csv_report(spark, str(tmp_path), ("a", "b"), keep_corrupt=True)
    good, bad = rejects.split_unreadable(read)
    assert [tuple(r) for r in good.collect()] == [("1", "2")]
    assert sorted(r.CSV_DATA for r in bad.collect()) == ["3", "4,5,6"]


def test_failed_step_is_logged_and_stops(spark):
    log = Table(spark, scratch_path(spark, "failures"), tables.MARKETING_ETL_ERRORS)
    with pytest.raises(RuntimeError), rejects.logged_step(log, "load_ads"):
        raise RuntimeError("no such folder")
    (row,) = log.read().collect()
    assert (row.FILE_NAME, row.ERROR_MSG) == ("load_ads", "no such folder")
    with rejects.logged_step(log, "load_posts"):
        pass
    assert log.read().count() == 1


def test_long_raw_text_is_kept_and_marked(make):
    df = make([("x" * 2_000_001,), ("y",)], "raw string")
    whole = rejects.as_rejects(df, F.lit("r" * 2000), "raw").orderBy("CSV_DATA").collect()
    assert [(len(r.CSV_DATA), r.TRUNCATED, len(r.ERROR_TEXT)) for r in whole] == [(2_000_001, True, 2000), (1, False, 2000)]
