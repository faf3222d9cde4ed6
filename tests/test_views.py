"""Reporting views over hand-made rows."""

import datetime as dt
from decimal import Decimal

import pytest

from spendloom.contracts import tables as t
from spendloom.plans import views

DAY = dt.date(2018, 8, 1)


@pytest.fixture
def rows(make):
    """Contract rows from dicts; columns left out are NULL."""

    def build(contract, *dicts):
        data = [tuple(_typed(f, d.get(f.name)) for f in contract.fields) for d in dicts]
        return make(data, contract.schema)

    return build


def _typed(field, value):
    return Decimal(str(value)) if value is not None and field.dtype.typeName() == "decimal" else value


@pytest.fixture
def spend(rows):
    def build(adwords=(), linkedin=(), facebook=(), posts=()):
        return {
            "GOOGLE_ADWORDS": rows(t.GOOGLE_ADWORDS, *adwords),
            "LINKEDIN_ADS": rows(t.LINKEDIN_ADS, *linkedin),
            "FACEBOOK_ADS": rows(t.FACEBOOK_ADS, *facebook),
            "HUBSPOT_SOCIAL_POSTS": rows(t.HUBSPOT_SOCIAL_POSTS, *posts),
        }

    return build


def test_daily_spend_per_platform(spend):
    ad = {"AD_DATE": DAY, "CLICKS": 3, "IMPRESSIONS": 2000, "COST": "10.00", "SPEND": "10.00"}
    df = views.daily_spend(
        spend(
            [{**ad, "CAMPAIGN_NAME": "MC J", "ADGROUP_NAME": "g", "HEADLINE": "h", "DESCRIPTION": "d", "AD_ID": 1, "CONVERSIONS": 4}],
            [{**ad, "PROGRAM": "CUON", "CAMPAIGN_NAME": "c", "CREATIVE_ID": 2}],
            [{**ad, "PROGRAM_NAME": "M CJ", "ADSET_NAME": "s", "AD_ID": 3, "TOTAL_ACTIONS": 5}],
            [{"POST_ID": "guid", "CAMPAIGN": "BAPS", "POST_CHANNEL": "Twitter", "CREATED_DATE": DAY, "POST_TITLE": "t", "CLICKS": 1, "ITERACTIONS": 0}],
        )
    )
    ratios = (Decimal("0.002"), Decimal("3.33"))
    assert sorted(tuple(r) for r in df.collect()) == [
        ("Paid", "Facebook", DAY, "MCJ", "s", "s", None, "3", 3, 5, Decimal("10.00"), 2000, *ratios),
        ("Paid", "Google Adwords", DAY, "MCJ", "g", "h", "d", "1", 3, 4, Decimal("10.00"), 2000, *ratios),
        ("Paid", "LinkedIn", DAY, "CU Online", "c", "c", None, "2", 3, None, Decimal("10.00"), 2000, *ratios),
        ("Social", "Twitter", DAY, "BAPS", "BAPS", "t", "t", "guid", 1, None, None, 0, None, None),
    ]


def test_paid_rows_need_impressions(spend):
    paid = [{"AD_ID": i, "IMPRESSIONS": n, "CLICKS": 0} for i, n in enumerate((0, None, 5))]
    got = views.daily_spend(spend(paid)).collect()
    assert [(r.AD_ID, r.CLICKS_PER_IMPRESSIONS, r.COST_PER_CLICK) for r in got] == [("2", 0, 0)]


def test_missing_counts_give_missing_ratios(spend):
    (row,) = views.daily_spend(spend([{"AD_ID": 1, "IMPRESSIONS": 5, "COST": "1.00"}])).collect()
    assert (row.CLICKS_PER_IMPRESSIONS, row.COST_PER_CLICK) == (None, None)


def test_schema_is_the_contract(spend):
    types = [(f.name, f.dataType) for f in views.daily_spend(spend()).schema]
    assert types == [(f.name, f.dtype) for f in views.DAILY_SPEND.fields]


def survey(rows, contacts, answers):
    return views.contacts_with_survey(
        {
            "HUBSPOT_CONTACTS": rows(t.HUBSPOT_CONTACTS, *contacts),
            "ASK_NICELY_RESPONSES": rows(t.ASK_NICELY_RESPONSES, *answers),
        }
    )


A = {"EMAIL": "a@Example.org", "ANSWER": 1}
B = {"EMAIL": "b@example.org", "ANSWER": 2}


@pytest.mark.parametrize(
    "mails, answers",
    [
        (("A@example.org", "b@example.org"), [1, 2]),  # both match
        (("a@example.org", None), [None, 1]),  # one matches, the other branch has no answer
        (("a@example.org", "none@example.org"), [None, 1]),
        (("a@example.org", "A@EXAMPLE.ORG"), [1]),  # the same answer twice
        (("x@example.org", None), [None]),
        ((None, None), [None]),
    ],
)
def test_contacts_with_survey(rows, mails, answers):
    df = survey(rows, [{"VID": 1, "EMAIL": mails[0], "CU_EMAIL": mails[1]}], [A, A, B, {"EMAIL": None, "ANSWER": 9}])
    got = sorted((r.ANSWER for r in df.collect()), key=lambda v: (v is not None, v))
    assert got == answers


def test_survey_emails_are_upper_case_and_rows_distinct(rows):
    contact = {"VID": 1, "EMAIL": "a@example.org"}
    (first, second) = survey(rows, [contact, contact], [A]).orderBy("ANSWER").collect()
    assert (first.EMAIL, first.ANSWER, second.ANSWER) == ("A@EXAMPLE.ORG", None, 1)


def test_linkedin_view_joins_through_the_link(rows):
    tables = {
        "LINKEDIN_CAMPAIGN_CREATIVE_LINK": rows(
            t.STG_LINKEDIN_LINK,
            {"CAMPAIGN_ID": 1, "CREATIVE_ID": 10},
            {"CAMPAIGN_ID": 1, "CREATIVE_ID": 11},
            {"CAMPAIGN_ID": 2, "CREATIVE_ID": 12},
            {"CAMPAIGN_ID": None, "CREATIVE_ID": None},
        ),
        "LINKEDIN_CAMPAIGNS_UPDATED": rows(
            t.STG_LINKEDIN_CAMPAIGNS_UPDATED, {"ID": 1, "CAMPAIGN_NAME": "MSIS fall"}, {"ID": None}
        ),
        "LINKEDIN_ADS": rows(
            t.STG_LINKEDIN_ADS, *[{"CREATIVE_ID": c, "AD_DATE": DAY, "CLICKS": c} for c in (10, 10, 11, 12, 13, None)]
        ),
    }
    got = [(int(r.CAMPAIGN_ID), r.PROGRAM, int(r.CREATIVE_ID)) for r in views.linkedin_ads(tables).collect()]
    assert sorted(got) == [(1, "MSIS", 10), (1, "MSIS", 10), (1, "MSIS", 11)]


def test_contacts_view(rows):
    tables = {
        "HUBSPOT_CONTACTS_INFO": rows(t.STG_HUBSPOT_CONTACTS_INFO, *[{"VID": v} for v in (1, 2, 3)]),
        "HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS": rows(
            t.STG_HUBSPOT_PROGRAMS, {"VID": 1, "ACADEMIC_PROGRAM": "a"}, {"VID": 1, "ACADEMIC_PROGRAM": "b"}
        ),
        "HUBSPOT_CONTACTS": rows(t.STG_HUBSPOT_CONTACTS, {"VID": 1}, {"VID": 2}, {"VID": 2}, {"VID": 9}),
    }
    df = views.hubspot_contacts(tables)
    assert df.columns == t.HUBSPOT_CONTACTS.names
    got = sorted((int(r.VID), r.ACADEMIC_PROGRAM or "") for r in df.collect())
    assert got == [(1, "a"), (1, "b"), (2, ""), (2, "")]


def test_course_rollup(rows):
    course = {"CAMPUS_CD": "D", "ACADEMIC_YEAR": 2018, "TERM_CD": 1, "TERM_SD": "F", "INSTRCTN_MODE_CD": "OL"}
    df = views.course_rollup(
        {
            "COGNOS_COURSE_LISTS_PRD": rows(
                t.COURSE_LISTS_PRD,
                {**course, "ENRL_TOT": 10, "UNITS_MAXIMUM": "3.00"},
                {**course, "ENRL_TOT": 20, "UNITS_MAXIMUM": "1.50"},
                {**course, "CAMPUS_CD": "B", "ENRL_TOT": None, "UNITS_MAXIMUM": "1.00"},
            )
        },
        ordered=True,
    )
    got = [(r.CAMPUS_CD, r.COURSE_COUNT, r.ENROLLMENTS, r.CREDIT_HOURS, r.CREDIT_HOURS_WEIGHTED) for r in df.collect()]
    assert got == [("B", 1, None, None, None), ("D", 2, 30, Decimal("135.00"), Decimal("60.00"))]


def test_views_can_be_queried_by_name(spark, spend):
    ads = [{"AD_ID": i, "IMPRESSIONS": 5, "CLICKS": 1, "COST": c} for i, c in enumerate(("1.50", "2.25"))]
    views.register("MARKETING_DAILY_SPEND_VIEW", spend(ads))
    total = spark.sql(
        "SELECT MARKETING_PLATFORM, SUM(COST) AS COST FROM MARKETING_DAILY_SPEND_VIEW WHERE CLICKS > 0 GROUP BY 1"
    )
    assert [tuple(r) for r in total.collect()] == [("Google Adwords", Decimal("3.75"))]
    assert set(views.VIEWS) == {
        "MARKETING_DAILY_SPEND_VIEW",
        "HUBSPOT_WITH_ASK_NICELY_VIEW",
        "LINKEDIN_ADS_VIEW",
        "HUBSPOT_CONTACTS_VIEW",
        "COURSE_ROLLUP_VIEW",
    }
