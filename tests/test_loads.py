"""Source loads over small landed files."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from spendloom import tallies
from spendloom.contracts import tables as t
from spendloom.plans.loads import (
    adwords,
    contacts,
    contacts_legacy,
    content,
    courses,
    engagement,
    facebook,
    linkedin,
    social_posts,
    survey,
    web_analytics,
)
from spendloom.plans.loads.fields import Options
from spendloom.session import scratch_path, scratch_root
from spendloom.sources.pages import read_documents, read_pages
from spendloom.sources.tabular import POSITIONAL_PAGE
from spendloom.store import Table

MS = 1514764800000  # 2018-01-01 UTC
DAY = 86_400_000


@pytest.fixture
def new(spark):
    return lambda contract: Table(spark, scratch_path(spark, contract.name.lower()), contract)


@pytest.fixture
def land(tmp_path):
    count = iter(range(100))

    def write(name, *documents):
        folder = tmp_path / f"{name}{next(count)}"
        folder.mkdir()
        for i, doc in enumerate(documents):
            (folder / f"{i}.json").write_text(json.dumps(doc, indent=1))
        return str(folder)

    return write


def test_facebook(spark, land, new):
    ad = {"campaign_name": "MSIS fall", "clicks": "5", "impressions": "10", "spend": "1.5", "date_start": "2018-08-20"}
    pages = land(
        "facebook",
        {"data": [{**ad, "ad_id": "1"}, {**ad, "ad_id": "2", "clicks": ""}, {**ad, "ad_id": "x"}]},
        {"data": [{**ad, "ad_id": "3", "date_start": "2018-07-01"}, {**ad, "ad_id": "4", "date_start": "2018-09-01"}]},
    )
    staging, production, bad = new(t.STG_FACEBOOK_ADS_0818), new(t.FACEBOOK_ADS), new(t.ERROR_TABLE)
    run = lambda: facebook.run(spark, pages, staging, production, bad, "2018-09-01")
    got = sorted((int(r.AD_ID), r.PROGRAM_NAME, r.CLICKS, r.SOCIAL_SPEND) for r in run().collect())
    assert got == [(1, "MSIS", 5, None), (2, "MSIS", None, None)]
    assert [r.ERROR_TEXT for r in bad.read().collect()] == ["AD_ID: not a decimal(18,0)"]
    assert run().count() == 2


def test_restated_metrics_are_ignored(spark, land, new):
    ad = {"ad_id": "1", "date_start": "2018-08-20", "impressions": "10"}
    staging, production, bad = new(t.STG_FACEBOOK_ADS_0818), new(t.FACEBOOK_ADS), new(t.ERROR_TABLE)
    facebook.run(spark, land("a", {"data": [{**ad, "clicks": "1"}]}), staging, production, bad, "2018-09-01")
    facebook.run(spark, land("b", {"data": [{**ad, "clicks": "2"}]}), staging, production, bad, "2018-09-01")
    assert [int(r.CLICKS) for r in production.read().collect()] == [1]


def test_adwords(spark, tmp_path, new):
    line = {h: "" for h in adwords.HEADERS} | {"Day": "2018-08-20", "Ad ID": "1", "CTR": "5.25%", "Cost": "1230000"}
    broken = line | {"Ad ID": "2", "CTR": "--"}
    with open(tmp_path / "report.csv", "w") as out:
        for row in (adwords.HEADERS, line.values(), broken.values()):
            out.write(",".join(row) + "\n")
    bad = new(t.ERROR_TABLE)
    got = adwords.run(spark, str(tmp_path), new(t.STG_GOOGLE_ADWORDS), new(t.GOOGLE_ADWORDS), bad, "2018-09-01")
    (row,) = got.collect()
    assert (float(row.CLICK_THROUGH_RATE), float(row.COST), row.ENGAGEMENT_RATE) == (0.0525, 1.23, None)
    assert [r.ERROR_TEXT for r in bad.read().collect()] == ["CLICK_THROUGH_RATE: not a decimal(18,10)"]


def linkedin_pages(land, clicks):
    account = {"name": "x"}
    campaign = {"changeAuditStamps": {"created": {"time": MS}, "lastModified": {"time": MS}}, "name": "MSIS fall", "costType": "CPC"}
    creative = {"status": "ACTIVE", "changeAuditStamps": {"created": {"time": MS}}}
    day = lambda d: {"start": {"day": d.day, "month": d.month, "year": d.year}}
    return {
        "accounts": land(
            "accounts",
            {"elements": [{**account, "id": 1, "type": "BUSINESS"}, {**account, "id": 2, "type": "PERSONAL"}, {**account, "id": 3}]},
        ),
        "campaigns": land(
            "campaigns",
            {"elements": [{**campaign, "id": 10 + a, "account": f"urn:li:sponsoredAccount:{a}"} for a in (1, 2, 3, 4)]},
        ),
        "creatives": land(
            "creatives",
            {"elements": [{**creative, "id": 100 + c, "campaign": f"urn:li:sponsoredCampaign:{c}"} for c in (11, 12, 13)]},
            {"elements": [{**creative, "id": 200, "campaign": "urn:li:sponsoredCampaign:11", "status": "PAUSED"}]},
        ),
        "ads": land(
            "ads",
            *[
                {
                    "creative": f"urn:li:sponsoredCreative:{c}",
                    "elements": [{"clicks": n, "dateRange": day(d)} for d, n in clicks.get(c, {}).items()],
                }
                for c in (111, 112, 113, 200)
            ],
        ),
    }


@pytest.fixture
def linkedin_staging(new):
    return {
        "campaigns": new(t.STG_LINKEDIN_CAMPAIGNS_UPDATED),
        "creatives": new(t.STG_LINKEDIN_LINK),
        "ads": new(t.STG_LINKEDIN_ADS),
        "batch": new(t.STG_LINKEDIN_ADS_VIEW),
    }


def test_linkedin(spark, land, new, linkedin_staging):
    d1, d2, d3 = (dt.date(2018, 8, n) for n in (1, 2, 3))
    production, bad = new(t.LINKEDIN_ADS), new(t.ERROR_TABLE)

    def run(clicks, as_of):
        linkedin.run(spark, linkedin_pages(land, clicks), linkedin_staging, production, bad, as_of)
        return sorted((int(r.CREATIVE_ID), r.AD_DATE.day, int(r.CLICKS)) for r in production.read().collect())

    # Personal, unknown and paused ones stay out; a missing account type counts as business.
    first = run({111: {d1: 1, d2: 2}, 112: {d1: 9}, 113: {d2: 3}, 200: {d1: 9}}, d2)
    assert first == [(111, 1, 1), (111, 2, 2), (113, 2, 3)]
    # The newest day is reloaded, older days keep their first figures, the running day comes in.
    second = run({111: {d1: 50, d2: 60, d3: 70}, 113: {d2: 80}}, d3)
    assert second == [(111, 1, 1), (111, 2, 60), (111, 3, 70), (113, 2, 80)]
    row = production.read().filter("CREATIVE_ID = 113").first()
    assert (int(row.CAMPAIGN_ID), row.PROGRAM, str(row.CREATED_DATE), row.START_DATE) == (13, "MSIS", "2018-01-01", None)
    # The same batch again changes nothing.
    assert run({111: {d1: 50, d2: 60, d3: 70}, 113: {d2: 80}}, d3) == second
    # A source without the newest day clears it.
    assert run({111: {d1: 1}}, d3) == [r for r in second if r[1] < 3]


def test_loading_in_place_equals_the_merge(spark, make, new):
    rows = lambda *r: t.LINKEDIN_ADS.conform(
        make([(c, dt.date(2018, 8, d), n) for c, d, n in r], "CAMPAIGN_ID int, AD_DATE date, CLICKS int")
    )
    stored = rows((1, 1, 10), (1, 2, 20), (2, 2, 30), (1, 3, 40), (2, 3, 50))
    batch = rows((1, 2, 21), (3, 2, 22), (1, 3, 41), (1, 3, 42), (1, 4, 43))
    production, staged = new(t.LINKEDIN_ADS), new(t.STG_LINKEDIN_ADS_VIEW)
    production.append(stored)
    staged.replace(batch)
    want = sorted(map(str, linkedin.merged(production.read(), staged.read()).collect()))
    linkedin.load(production, staged.read())
    assert sorted(map(str, production.read().collect())) == want
    linkedin.load(production, staged.read())
    assert sorted(map(str, production.read().collect())) == want


def test_later_creative_of_a_loaded_campaign_day_is_dropped(make):
    rows = lambda *r: t.LINKEDIN_ADS.conform(
        make([(c, dt.date(2018, 8, d), n) for c, d, n in r], "CAMPAIGN_ID int, AD_DATE date, CREATIVE_ID int")
    )
    got = linkedin.merged(rows((1, 1, 100), (1, 2, 100)), rows((1, 1, 100), (1, 1, 101), (1, 2, 100), (1, 2, 101)))
    assert sorted((r.AD_DATE.day, int(r.CREATIVE_ID)) for r in got.collect()) == [(1, 100), (2, 100), (2, 101)]


def test_missing_linkedin_metrics_stay_missing_unless_asked(make):
    links = make([(100, "ACTIVE")], "CREATIVE_ID int, STATUS string")
    schema = f"creative string, {linkedin.ANALYTICS}"
    blank = (None,) * 12
    ads = make([("urn:li:sponsoredCreative:100", *blank, ((1, 8, 2018),))], schema)
    assert linkedin.extract_ads(ads, links, "2018-08-01").good.first().CLICKS is None
    assert linkedin.extract_ads(ads, links, "2018-08-01", zero_missing=True).good.first().CLICKS == 0


def test_survey(spark, land, new):
    seconds = MS // 1000
    answer = {"name": "n", "segment": "s", "email": "e", "answer": 9}
    staging, production, bad = new(t.ASK_NICELY_RESPONSES), new(t.ASK_NICELY_RESPONSES), new(t.ERROR_TABLE)
    run = lambda path: survey.run(spark, path, staging, production, bad, "2018-01-03")
    assert run(land("none", {"data": []})).count() == 0 and not production.exists()
    page = {"data": [{**answer, "response_id": i, "responded": seconds + i * 86_400} for i in (-8, 0, 1, 2)]}
    got = run(land("some", page))
    assert sorted((int(r.RESPONSE_ID), str(r.RESPONSE_DATE)) for r in got.collect()) == [
        (0, "2018-01-01"),
        (1, "2018-01-02"),
    ]


def test_social_posts(spark, land, new):
    post = {"campaignGuid": "15cc12bb-009b-4874-aa24-c73417225558", "channelKey": "FacebookPage:77", "createdAt": MS - 1, "content": {"title": "first"}, "clicks": 1, "likes": 2}
    staging, production, bad = new(t.STG_HUBSPOT_SOCIAL_POSTS), new(t.HUBSPOT_SOCIAL_POSTS), new(t.ERROR_TABLE)
    run = lambda path: social_posts.run(spark, path, staging, production, bad)
    run(land("a", [{**post, "broadcastGuid": "p1"}]))
    later = {**post, "clicks": 5, "content": {"title": "second"}, "campaignGuid": "unknown"}
    got = run(land("b", [{**later, "broadcastGuid": "p1"}, {**later, "broadcastGuid": "p2", "channelKey": "Twitter"}]))
    assert sorted((r.POST_ID, r.CAMPAIGN, r.POST_CHANNEL, str(r.CREATED_DATE), r.POST_TITLE, int(r.CLICKS)) for r in got.collect()) == [
        ("p1", "MSIS", "Facebook", "2017-12-31", "first", 5),
        ("p2", "CU Online", "Twitter", "2017-12-31", "second", 5),
    ]


def contact(vid, programs=None, modified=MS, **values):
    entries = {k: {"value": v} for k, v in {**values, "academic_program": programs, "lastmodifieddate": str(modified)}.items() if v is not None}
    entries["lifecyclestage"] = {"value": "lead", "versions": [{"value": "lead", "timestamp": MS}, {"value": "old", "timestamp": 1}]}
    return {"vid": vid, "properties": entries, "form-submissions": [{"title": "apply", "timestamp": MS}]}


def contact_pages(land, name, *people):
    ids = [{"vid": p["vid"], "properties": {"lastmodifieddate": p["properties"]["lastmodifieddate"]}} for p in people]
    return {"ids": land(name + "_ids", {"contacts": ids, "has-more": False}), "profiles": land(name + "_profiles", *people)}


def test_contacts(spark, land, new):
    staging = {
        "ids": new(t.STG_HUBSPOT_CONTACTS),
        "info": new(t.STG_HUBSPOT_CONTACTS_INFO),
        "programs": new(t.STG_HUBSPOT_PROGRAMS),
        "batch": new(t.STG_HUBSPOT_CONTACTS_VIEW),
    }
    production, bad = new(t.HUBSPOT_CONTACTS), new(t.ERROR_TABLE)

    def run(pages):
        contacts.run(spark, pages, staging, production, bad, "2018-02-01", Options(tz="America/New_York"))
        return sorted((int(r.VID), r.ACADEMIC_PROGRAM or "", r.FIRST_NAME) for r in production.read().collect())

    first = contact_pages(
        land, "a", contact(1, firstname="A", modified=MS - 5 * DAY), contact(2, "x;y", firstname="B"), contact(3, "x", firstname="C")
    )
    assert run(first) == [(1, "", "A"), (2, "x", "B"), (2, "y", "B"), (3, "x", "C")]
    row = production.read().filter("VID = 2").first()
    assert (str(row.LIFECYCLE_STAGE_DATE), str(row.IMPORT_DATE), row.EMAIL) == ("2017-12-31", "2018-02-01", None)
    # Only changes since the newest stored day are taken; all rows of a contact are replaced.
    second = contact_pages(
        land,
        "b",
        contact(1, "z", firstname="AA", modified=MS - 4 * DAY),
        contact(2, "y;z", firstname="BB", modified=MS + DAY),
        contact(4, firstname="D", modified=MS + DAY),
    )
    assert run(second) == [(1, "", "A"), (2, "y", "BB"), (2, "z", "BB"), (3, "x", "C"), (4, "", "D")]


def test_contact_whose_property_is_too_long_is_rejected(spark, land, new):
    staged, bad = new(t.STG_HUBSPOT_CONTACTS_INFO), new(t.ERROR_TABLE)
    docs = read_documents(spark, land("p", contact(1, zip="1" * 11), contact(2, zip="12345")), contacts.PROFILE)
    staged.stage(contacts.extract_info(docs, "2018-01-01"), bad)
    assert [int(r.VID) for r in staged.read().collect()] == [2]
    assert bad.read().first().ERROR_TEXT == "HOME_ZIP: longer than 10"


def test_legacy_contacts(spark, land, new):
    stored, programs = new(contacts_legacy.HS_CONTACTS), new(contacts_legacy.HS_CONTACT_PROGRAM)

    def run(loaded_at, *people):
        pages = contact_pages(land, loaded_at, *people)
        one, two = contacts_legacy.run(spark, pages, stored, programs, loaded_at)
        return (
            sorted((int(r.VID), r.LOADED_AT, r.UPDATED_AT) for r in one.collect()),
            sorted((int(r.VID), r.ACADEMIC_PROGRAM or "") for r in two.collect()),
        )

    t0, t1 = "2018-01-01 00:00:00", "2018-01-02 00:00:00"
    assert run("n1", contact(1, "a;b"), contact(2)) == ([(1, "n1", t0), (2, "n1", t0)], [(1, "a"), (1, "b"), (2, "")])
    got = run("n2", contact(1, "c", MS + DAY), contact(2, "ignored"), contact(3, "d"))
    assert got == ([(1, "n2", t1), (2, "n1", t0), (3, "n2", t0)], [(1, "c"), (2, ""), (3, "d")])


def test_legacy_contact_without_a_profile_is_removed(spark, land, new):
    stored, programs = new(contacts_legacy.HS_CONTACTS), new(contacts_legacy.HS_CONTACT_PROGRAM)
    contacts_legacy.run(spark, contact_pages(land, "n1", contact(1, "a"), contact(2, "b")), stored, programs, "n1")
    later = contact_pages(land, "n2", contact(1, "c", MS + DAY))
    later["profiles"] = land("no_profiles", contact(9))
    people, listed = contacts_legacy.run(spark, later, stored, programs, "n2")
    assert [int(r.VID) for r in people.collect()] == [2]
    assert [(int(r.VID), r.ACADEMIC_PROGRAM) for r in listed.collect()] == [(2, "b")]


def test_forms_of_stale_contacts(spark, land, make):
    docs = read_documents(spark, land("f", contact(1), contact(2), contact(3)), contacts.PROFILE)
    people = make([(1, "b"), (2, "b"), (3, "b")], "VID int, UPDATED_AT string")
    forms = contacts_legacy.HS_CONTACT_FORMS.conform(make([(1, "old", "a"), (2, "old", "c")], "VID int, FORM string, UPDATEDAT string"))
    got = contacts_legacy.refreshed_forms(contacts_legacy.HS_CONTACTS.conform(people), forms, docs, "now")
    assert sorted((int(r.VID), r.FORM, r.UPDATEDAT) for r in got.collect()) == [(1, "old", "a"), (2, "apply", "now"), (3, "apply", "now")]


def test_engagements(spark, land):
    page = {
        "results": [
            {
                "engagement": {"id": 5, "active": False, "createdAt": MS, "ownerId": 0},
                "associations": {"contactIds": [7, 8], "dealIds": []},
                "metadata": {"from": {"email": "a@b.c"}, "to": [], "body": "<p>one\r\ntwo", "reminders": [0]},
            },
            {"engagement": {"id": 6}},
        ]
    }
    got = engagement.engagements(read_pages(spark, land("e", page), "results", engagement.ENGAGEMENT)).orderBy("ENGAGEMENT_ID").collect()
    first = got[0]
    assert len(got) == 2 and len(got[0]) == 35
    assert (first.ENGAGEMENT_ID, first.ACTIVE, first.CREATED_AT, first.CONTACT_ID, first.DEAL_ID) == ("5", None, "2018-01-01 00:00:00", "7", None)
    assert (first.FROM_EMAIL, first.TO_EMAIL, first.BODY, first.REMINDER, first.OWNER_ID) == ("a@b.c", None, "onetwo", "1970-01-01 00:00:00", None)


def test_workflows_of_listed_contacts(spark, land, make):
    flow = lambda n: {"id": n, "name": f"w{n}", "triggerSet": [{"trigger": [{"id": 1}, {"id": 2}]}, {"trigger": []}]}
    docs = land("w", {"vid": 1, "workflows": [flow(5), flow(6)]}, {"vid": 2, "workflows": []}, {"vid": 3, "workflows": [flow(7)]})
    enrolments = read_documents(spark, docs, engagement.ENROLMENTS)
    got = engagement.contact_workflow(make([(1,), (2,)], "vid bigint"), enrolments)
    found = {(int(r.VID), int(r.WORKFLOW_ID), r.TRIGGER_ID and int(r.TRIGGER_ID)) for r in got.collect()}
    assert (got.count(), found) == (2, {(1, 5, 1), (1, 5, None)})


def test_zero_counters_are_missing_unless_kept(spark, land, make):
    docs = read_documents(spark, land("c", {"id": 1, "appId": 2, "counters": {"sent": 0, "open": 3}}), engagement.CAMPAIGN_DETAIL)
    ids = make([(1, 2)], "id bigint, appId bigint")
    (row,) = engagement.email_campaigns(ids, docs).collect()
    assert (row.SENT, row.OPEN) == (None, 3)
    (row,) = engagement.email_campaigns(ids, docs, Options(keep_falsy=True)).collect()
    assert (row.SENT, row.OPEN) == (0, 3)


def test_content_lists(spark, land):
    read = lambda name, record_path, record, *rows: read_pages(spark, land(name, {record_path: list(rows)}), record_path, record)
    blog = content.blogs(read("b", "objects", content.BLOG, {"id": 1, "created_date_time": MS})).first()
    assert (blog.ID, blog.CREATED_AT) == (1, "2018-01-01 00:00:00")
    post = content.blog_posts(read("p", "objects", content.BLOG_POST, {"id": 1, "currently_published": False, "comment_count": 2})).first()
    assert (post.CURRENTLY_PUBLISHED, post.COMMENT_COUNT) == (None, 2)
    word = content.keywords(read("k", "keywords", content.KEYWORD, {"keyword": "x", "visits": 0, "leads": 4})).first()
    assert (word.KEYWORD, word.VISITS, word.LEADS) == ("x", None, 4)
    flow = content.workflows(read("w", "workflows", content.WORKFLOW, {"id": 1, "enabled": True, "contactCounts": {"active": 3}})).first()
    assert (flow.ENABLED, flow.COUNT_ACTIVE, flow.LIST_ACTIVE, flow.FIRST_STEPS) == ("true", 3, None, None)


def analytics(spark, land, report, *rows):
    pages = read_documents(spark, land(report[0].name, {"rows": list(rows)}), POSITIONAL_PAGE)
    return web_analytics.extract(pages, report)


def test_campaign_report_dates_are_parsed(spark, land):
    row = ["a|b(not set)", "(direct)", "(not set)", "20180105", "77", "5", "1", "2.5", "0", "0", "0", "0", "0", "0.25"]
    batch = analytics(spark, land, web_analytics.CAMPAIGNS, row, row[:4], ["x"] * 14)
    full, short = sorted(batch.good.collect(), key=lambda r: r.IMPRESSIONS is None)
    assert (full.CAMPAIGN, full.SOURCE, full.AD_GROUP, str(full.REPORT_DATE)) == ("ab", None, None, "2018-01-05")
    assert (float(full.AD_COST), float(full.COST_PER_CONVERSION)) == (2.5, 0.25)
    assert (short.CAMPAIGN, short.IMPRESSIONS) == ("ab", None)
    assert batch.bad.count() == 1


def test_traffic_report(spark, land):
    row = ["(not set)", "c", "1", "k", "n", "(none)", "(direct)", "5"]
    (got,) = analytics(spark, land, web_analytics.TRAFFIC, row).good.collect()
    assert (got.FULL_REFERRER, got.MEDIUM, got.SOURCE, got.ORGANIC_SEARCHES) == (None, None, "direct", 5)


def test_course_lists_are_typed(make):
    df = make([("2018", "1", "3.00", "30"), ("2018", "1", "1-3", "30")], "Y string, TERM_CD string, UNITS_MAXIMUM string, ENRL_TOT string")
    batch = courses.typed(df, F.col("Y"))
    assert [(r.ACADEMIC_YEAR, float(r.UNITS_MAXIMUM)) for r in batch.good.collect()] == [(2018, 3.0)]
    assert [r.ERROR_TEXT for r in batch.bad.collect()] == ["UNITS_MAXIMUM: not a decimal(18,2)"]


# --- nothing leaves a load unseen ----------------------------------------------------------

CUT_OFF = '{"data": [{"response_id": "3", "responded": "1535760000", "answer": "9"}, {"response_id": "4", "resp'


def table_of(spark, contract):
    return Table(spark, scratch_path(spark, contract.name.lower()), contract)


def test_survey_rows_are_loaded_rejected_or_outside_the_window(spark, tmp_path):
    day = 86_400
    asof = 17_800 * day  # 2018-09-26
    sent = [("1", str(asof - day)), ("2", "soon"), ("5", ""), ("6", str(asof - 400 * day)), ("7", None)]
    (tmp_path / "a.json").write_text(json.dumps({"data": [{"response_id": i, "responded": at} for i, at in sent]}))
    (tmp_path / "b.json").write_text(CUT_OFF)
    rejects = table_of(spark, t.ERROR_TABLE)
    loaded = survey.run(
        spark, str(tmp_path), table_of(spark, t.ASK_NICELY_RESPONSES), table_of(spark, t.ASK_NICELY_RESPONSES), rejects, "2018-09-26"
    )
    assert [str(r.RESPONSE_ID) for r in loaded.collect()] == ["1"]
    found = sorted((r.ERROR_TEXT, r.CSV_DATA) for r in rejects.read().collect())
    assert [e.split(":")[-1].strip() for e, _ in found if e.startswith("RESPONSE_DATE")] == ["missing", "missing", "not a date"]
    assert [raw for e, raw in found if e.startswith("unreadable")] == [CUT_OFF]


def test_records_with_values_of_another_type_are_rejected(spark, tmp_path):
    good = json.dumps({"objects": [{"id": n} for n in range(1, 101)]})
    mixed = json.dumps({"objects": [{"id": "two" if n == 142 else n, "html_title": "ü"} for n in range(101, 201)]}, indent=1)
    (tmp_path / "a.json").write_text(good)
    (tmp_path / "b.json").write_text(mixed)
    (tmp_path / "c.json").write_text(CUT_OFF)
    stored, rejects = table_of(spark, content.BLOGS.contract), table_of(spark, t.ERROR_TABLE)
    rows = content.run(spark, str(tmp_path), content.BLOGS, stored, rejects=rejects).collect()
    assert sorted(int(r.ID) for r in rows) == [n for n in range(1, 201) if n != 142]
    assert sorted(r.CSV_DATA for r in rejects.read().collect()) == sorted(['{"id":"two","html_title":"ü"}', CUT_OFF])
    with pytest.raises(ValueError, match="unreadable"):
        content.run(spark, str(tmp_path), content.BLOGS, stored)
    assert stored.read().count() == 199


def test_counts_of_a_load_balance(spark, tmp_path, caplog):
    days = ["2018-09-20", "2018-09-21", "2018-01-01", "soon"]
    records = [{"ad_id": str(i), "date_start": d, "clicks": "1"} for i, d in enumerate(days * 3)]
    (tmp_path / "a.json").write_text(json.dumps({"data": [*records, 7]}))
    (tmp_path / "b.json").write_text(CUT_OFF)
    rejects = table_of(spark, t.ERROR_TABLE)
    with caplog.at_level("INFO", "spendloom.loads"), tallies.collected() as found:
        facebook.run(spark, str(tmp_path), table_of(spark, t.STG_FACEBOOK_ADS_0818), table_of(spark, t.FACEBOOK_ADS), rejects, "2018-09-26")
    read, staged = found
    assert (read.landed, read.loaded, read.rejected) == (14, 12, 2)
    assert (staged.landed, staged.loaded, staged.rejected, staged.outside) == (12, 6, 3, 3)
    assert read.balanced and staged.balanced and not tallies.Tally("x", 3, 1, 1).balanced
    assert "12 landed, 6 loaded, 3 rejected, 3 outside" in caplog.text and rejects.read().count() == 5


def test_nothing_that_a_load_parsed_is_left_behind(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps({"objects": [{"id": 1}, {"id": "two"}]}))
    before = set(os.listdir(f"{scratch_root(spark)}/spendloom"))
    stored, rejects = table_of(spark, content.BLOGS.contract), table_of(spark, t.ERROR_TABLE)
    content.run(spark, str(tmp_path), content.BLOGS, stored, rejects=rejects)
    left = set(os.listdir(f"{scratch_root(spark)}/spendloom")) - before
    assert not [n for n in left if n.startswith(("landed", "torn"))]


def test_report_lines_of_another_length_are_rejected(spark, tmp_path):
    names = list(adwords.HEADERS)
    line = ["x"] * len(names)
    day, ad = names.index("Day") if "Day" in names else 0, names.index("Ad ID")
    line[ad] = "7"
    numbers = {i: "1" for i, n in enumerate(names) if adwords.HEADERS[n] not in ("AD_DATE",)}
    full = [numbers.get(i, "2018-09-20") for i in range(len(names))]
    full[day] = "2018-09-20"
    quoted = list(full)
    quoted[names.index("Headline 1")] = '"two\nlines"'
    text = "\n".join([",".join(f'"{n}"' for n in names), ",".join(full), ",".join(full[:5]), ",".join(quoted)])
    (tmp_path / "r.csv").write_text(text + "\n")
    rejects = table_of(spark, t.ERROR_TABLE)
    adwords.run(
        spark, str(tmp_path / "r.csv"), table_of(spark, t.STG_GOOGLE_ADWORDS), table_of(spark, t.GOOGLE_ADWORDS), rejects, "2018-09-26"
    )
    found = [r.CSV_DATA for r in rejects.read().collect()]
    assert len(found) == 1 and ",".join(full[:5]) in found[0]


def test_a_failing_load_is_logged_and_stops(spark, tmp_path):
    log = table_of(spark, t.MARKETING_ETL_ERRORS)
    with pytest.raises(Exception, match="absent"):
        facebook.run(
            spark, str(tmp_path / "absent"), table_of(spark, t.STG_FACEBOOK_ADS_0818), table_of(spark, t.FACEBOOK_ADS),
            table_of(spark, t.ERROR_TABLE), "2018-09-01", log=log,
        )
    [row] = log.read().collect()
    assert row.FILE_NAME == "facebook" and "absent" in row.ERROR_MSG and len(row.ERROR_MSG) > 100


def test_legacy_contacts_do_not_double_after_a_stop(spark, tmp_path, monkeypatch):
    ids, profiles = tmp_path / "ids", tmp_path / "profiles"
    ids.mkdir()
    profiles.mkdir()
    changed = {"lastmodifieddate": {"value": str(MS)}}
    (ids / "a.json").write_text(json.dumps({"contacts": [{"vid": 7, "properties": changed}]}))
    props = changed | {"academic_program": {"value": "X;Y"}}
    (profiles / "7.json").write_text(json.dumps({"vid": 7, "properties": props}))
    landing = {"ids": str(ids), "profiles": str(profiles)}
    contacts, programs = table_of(spark, contacts_legacy.HS_CONTACTS), table_of(spark, contacts_legacy.HS_CONTACT_PROGRAM)
    whole = Table.merge_into

    def stop(self, *args):
        if self is contacts:
            raise OSError("stopped")
        whole(self, *args)

    with monkeypatch.context() as m:
        m.setattr(Table, "merge_into", stop)
        with pytest.raises(OSError):
            contacts_legacy.run(spark, landing, contacts, programs, "2018-09-01")
    contacts_legacy.run(spark, landing, contacts, programs, "2018-09-01")
    contacts_legacy.run(spark, landing, contacts, programs, "2018-09-02")
    assert sorted(r.ACADEMIC_PROGRAM for r in programs.read().collect()) == ["X", "Y"] and contacts.read().count() == 1
