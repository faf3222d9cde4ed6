"""Edge cases of the column expressions."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from spendloom.functions import dates, lookups, numbers, paths, text


def one(spark, col, **inputs):
    """Value of an expression over one row of named inputs."""
    base = spark.range(1).select(*[F.lit(v).alias(k) for k, v in inputs.items()] or [F.lit(1)])
    return base.select(col.alias("v")).first()[0]


@pytest.mark.parametrize(
    "ms, day",
    [
        ("1514764799999", "2017-12-31"),
        ("1514764800000", "2018-01-01"),
        ("-1", "1969-12-31"),
        ("", None),
        ("soon", None),
        (None, None),
        ("9223372036854775807", None),
    ],
)
def test_epoch_ms_date(spark, ms, day):
    got = one(spark, dates.epoch_ms_date(F.lit(ms).cast("string")))
    assert (str(got) if got else None) == day


@pytest.mark.parametrize("session_tz", ["UTC", "Asia/Tokyo", "America/New_York"])
def test_dates_do_not_depend_on_the_session_zone(spark, session_tz):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", session_tz)
    try:
        noon = F.lit(1514764800000)
        assert one(spark, dates.epoch_ms_date(noon).cast("string")) == "2018-01-01"
        assert one(spark, dates.epoch_s_date(F.lit(1514764800)).cast("string")) == "2018-01-01"
        assert one(spark, dates.epoch_ms_local_date(noon, "America/New_York")) == "2017-12-31"
        assert one(spark, dates.epoch_ms_local_ts(noon, "Asia/Tokyo")) == "2018-01-01 09:00:00"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_local_time_follows_daylight_saving(spark):
    july, january = F.lit(1530403200000), F.lit(1514764800000)
    assert one(spark, dates.epoch_ms_local_ts(july, "America/New_York")) == "2018-06-30 20:00:00"
    assert one(spark, dates.epoch_ms_local_ts(january, "America/New_York")) == "2017-12-31 19:00:00"


def test_birthdates_before_1970(spark):
    ms = F.lit(-86_400_000 * 365)
    assert one(spark, dates.epoch_ms_local_date(ms, "UTC")) == "1969-01-01"
    assert one(spark, dates.epoch_ms_local_date(ms, "UTC", mirror=True)) == "1971-01-01"


def test_fractional_seconds_are_cut(spark):
    assert one(spark, dates.epoch_ms_local_ts(F.lit(1514764800999), "UTC")) == "2018-01-01 00:00:00"


def test_dates_from_parts(spark):
    part = lambda y, m, d: one(spark, dates.date_from_parts(F.lit(y), F.lit(m), F.lit(d)))
    assert part(2018, 1, 5) == dt.date(2018, 1, 5)
    assert part(2018, 2, 30) is None
    assert part(2018, None, 5) is None


def test_report_date(spark):
    assert one(spark, dates.report_date(F.lit("20180105"))) == dt.date(2018, 1, 5)
    assert one(spark, dates.report_date(F.lit("(not set)"))) is None


def test_ids_at_the_end_of_a_urn(spark):
    urn = F.lit("urn:li:sponsoredCampaign:1234567890")
    assert one(spark, text.trailing_digits(urn)) == "1234567890"
    assert one(spark, text.trailing(urn, 9)) == "234567890"
    assert one(spark, text.trailing_digits(F.lit("none"))) is None


def test_sentinels_and_markup(spark):
    assert one(spark, text.remove(F.lit("a(not set)b"), text.NOT_SET)) == "ab"
    assert one(spark, text.remove(F.lit("a|b|"), "|")) == "ab"
    assert one(spark, text.strip_markup(F.lit("<p>a\r\nb</p>"))) == "ab</p>"
    assert one(spark, text.unescape(F.lit("R&amp;D isn&#39;t &39;"))) == "RandD isnt "
    assert one(spark, text.first_part(F.lit("FacebookPage:1:2"), ":")) == "FacebookPage"
    assert one(spark, text.items(F.lit("a;;b"))) == ["a", "", "b"]
    assert one(spark, text.items(F.lit(None).cast("string"))) == [""]


@pytest.mark.parametrize(
    "shown, rate", [("5.25%", "0.0525"), ("0%", "0"), ("100.00%", "1"), ("--", None), ("", None), (None, None)]
)
def test_percent(spark, shown, rate):
    got = one(spark, numbers.percent(F.lit(shown).cast("string")))
    assert got == (None if rate is None else Decimal(rate))


def test_micros(spark):
    assert one(spark, numbers.micros(F.lit("1234567"))) == Decimal("1.234567")
    assert one(spark, numbers.micros(F.lit("--"))) is None


@pytest.mark.parametrize(
    "num, den, ratio",
    [(1, 3, "0.333"), (1, 2000, "0.001"), (0, 5, "0"), (5, 0, "0"), (0, None, "0"), (None, 0, "0"), (None, 5, None), (5, None, None)],
)
def test_safe_ratio(spark, num, den, ratio):
    dec = lambda v: F.lit(v).cast("decimal(18,0)")
    got = one(spark, numbers.safe_ratio(dec(num), dec(den), 10, 3))
    assert got == (None if ratio is None else Decimal(ratio))


def test_program_spellings_differ_per_platform(spark):
    got = {p: one(spark, lookups.program_name(F.lit("M CJ"), p)) for p in lookups.PROGRAM_SPELLINGS}
    assert got == {"Google Adwords": "M CJ", "LinkedIn": "M CJ", "Facebook": "MCJ"}
    assert one(spark, lookups.program_name(F.lit("CUON"), "Google Adwords")) == "CUON"
    assert one(spark, lookups.program_name(F.lit(None).cast("string"), "LinkedIn")) is None


def test_missing_campaign_takes_the_default(spark):
    assert one(spark, lookups.campaign_program(F.lit(None).cast("string"))) == "CU Online"
    assert one(spark, lookups.channel_name(F.lit("Twitter"))) == "Twitter"
    assert one(spark, lookups.channel_name(F.lit(None).cast("string"))) is None


def test_lookup_table_keeps_unmapped_rows(make, values):
    df = make([("a", 1), ("x", 2), (None, 3)], "k string, n int")
    dim = make([("a", "Alpha")], "key string, name string")
    assert values(lookups.lookup(df, "k", dim, "key", "name", F.col("k"))) == [(None, 3), ("Alpha", 1), ("x", 2)]


DOC = "d struct<n bigint, on boolean, s string, list array<bigint>, m map<string, struct<value string>>>"


@pytest.mark.parametrize(
    "doc, path, value",
    [
        ((0, False, "", [], {}), ("d", "n"), None),
        ((7, True, "0", [0], {}), ("d", "n"), 7),
        ((0, False, "", [], {}), ("d", "on"), None),
        ((0, True, "", [], {}), ("d", "on"), True),
        ((0, False, "", [], {}), ("d", "s"), None),
        ((0, False, "0", [], {}), ("d", "s"), "0"),
        ((0, False, "false", [], {}), ("d", "s"), "false"),
        ((0, False, "", [], {}), ("d", "list"), None),
        ((0, False, "", [0, 1], {}), ("d", "list", 0), 0),
        ((0, False, "", [0, 1], {}), ("d", "list", 2), None),
        ((0, False, "", [], {"k": ("v",)}), ("d", "m", "k", "value"), "v"),
        ((0, False, "", [], {"k": ("",)}), ("d", "m", "k", "value"), None),
        ((0, False, "", [], {}), ("d", "m", "k", "value"), None),
        ((0, False, "", [], None), ("d", "m", "k", "value"), None),
    ],
)
def test_path_value(make, doc, path, value):
    df = make([(doc,)], DOC)
    assert df.select(paths.path_value(df, path).alias("v")).first()[0] == value


def test_path_value_can_keep_falsy(make):
    df = make([((0, False, "", [], {}),)], DOC)
    kept = [paths.path_value(df, ("d", f), keep_falsy=True).alias(f) for f in ("n", "on", "s", "list")]
    assert tuple(df.select(*kept).first()) == (0, False, "", [])


def test_unknown_path_fails_early(make):
    df = make([((0, False, "", [], {}),)], DOC)
    with pytest.raises((KeyError, ValueError)):
        paths.path_value(df, ("d", "nothing"))
    with pytest.raises(ValueError):
        paths.path_value(df, ("d", "n", "deeper"))
