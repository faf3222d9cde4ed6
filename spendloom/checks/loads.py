"""Source loads from landed files to stored tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.checks import domain, landing
from spendloom.checks.domain import with_
from spendloom.checks.functions import TZ
from spendloom.checks.landing import LINES, new_rejects, new_table
from spendloom.checks.relational import adwords_report
from spendloom.checks.registry import ORACLE, check, table
from spendloom.checks.sources import survey_records
from spendloom.contracts.tables import (
    ASK_NICELY_RESPONSES,
    FACEBOOK_ADS,
    GOOGLE_ADWORDS,
    HUBSPOT_CONTACTS,
    HUBSPOT_SOCIAL_POSTS,
    LINKEDIN_ADS,
    STG_FACEBOOK_ADS_0818,
    STG_GOOGLE_ADWORDS,
    STG_HUBSPOT_CONTACTS,
    STG_HUBSPOT_CONTACTS_INFO,
    STG_HUBSPOT_CONTACTS_VIEW,
    STG_HUBSPOT_PROGRAMS,
    STG_HUBSPOT_SOCIAL_POSTS,
    STG_LINKEDIN_ADS,
    STG_LINKEDIN_ADS_VIEW,
    STG_LINKEDIN_CAMPAIGNS_UPDATED,
    STG_LINKEDIN_LINK,
)
from spendloom.functions import lookups
from spendloom.plans.loads import (
    adwords,
    contacts,
    contacts_legacy,
    content,
    engagement,
    facebook,
    linkedin,
    social_posts,
    survey,
    web_analytics,
)
from spendloom.plans.loads.fields import Options
from spendloom.sources.pages import read_pages

LOCAL = Options(tz=TZ)
# The ads begin in January 1995.  Those of that month are stored, and all are
# landed two weeks into the next.
CUTOFF = "1995-02-01"
AS_OF = "1995-02-15"


def _local(millis: str) -> str:
    """Local time text of epoch milliseconds, in SQL."""
    return f"strftime(make_timestamp(CAST({millis} AS BIGINT) * 1000) - INTERVAL 7 HOUR, '%Y-%m-%d %H:%M:%S')"


def _before(df, day: str):
    return df.filter(F.col(day) < F.lit(CUTOFF).cast("date"))


# --- paid ads -----------------------------------------------------------------------


@check(
    "pipe_facebook",
    with_(sent=domain.SQL["facebook_ads"].replace(" FROM orders", ", o_orderstatus FROM orders"))
    + f""", prd AS (SELECT * FROM sent WHERE AD_DATE < DATE '{CUTOFF}')
    SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, PROGRAM_NAME, CLICKS + 1000 AS CLICKS,
      CAST(SPEND AS DOUBLE) AS SPEND, TOTAL_ACTIONS FROM prd
    UNION ALL SELECT AD_ID, CAST(AD_DATE AS VARCHAR), LEFT(CAMPAIGN_NAME, 4), CLICKS, CAST(SPEND AS DOUBLE), NULL
    FROM sent s WHERE o_orderstatus <> 'P' AND AD_DATE >= DATE '{AS_OF}' - 30 AND AD_DATE < DATE '{AS_OF}'
      AND NOT EXISTS (SELECT 1 FROM prd p WHERE p.AD_ID = s.AD_ID AND p.AD_DATE = s.AD_DATE)""",
)
def pipe_facebook(spark, sf):
    ads = domain.facebook_ads(spark, sf)
    open_ = table(spark, sf, "orders").select(F.col("o_orderkey").alias("AD_ID"), "o_orderstatus")
    # Ads of partly open orders arrive with an unusable click count.
    sent = ads.join(open_, "AD_ID").select(
        F.col("AD_ID").cast("string").alias("ad_id"),
        F.col("AD_DATE").cast("string").alias("date_start"),
        F.col("AD_DATE").cast("string").alias("date_stop"),
        F.col("CAMPAIGN_NAME").alias("campaign_name"),
        F.col("ADSET_NAME").alias("adset_name"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise(F.col("CLICKS").cast("string")).alias("clicks"),
        F.col("IMPRESSIONS").cast("string").alias("impressions"),
        F.col("SPEND").cast("string").alias("spend"),
    )
    stored = _before(ads, "AD_DATE").withColumn("CLICKS", F.col("CLICKS") + 1000)
    loaded = facebook.run(
        spark,
        landing.land_pages(sent, "data", "insights"),
        new_table(spark, STG_FACEBOOK_ADS_0818),
        new_table(spark, FACEBOOK_ADS, stored),
        new_rejects(spark),
        AS_OF,
        **LINES,
    )
    return loaded.select("AD_ID", "AD_DATE", "PROGRAM_NAME", "CLICKS", "SPEND", "TOTAL_ACTIONS")


@check(
    "pipe_adwords",
    with_(sent=domain.SQL["google_adwords"])
    + f""", prd AS (SELECT * FROM sent WHERE AD_DATE < DATE '{CUTOFF}')
    SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, HEADLINE, CLICKS + 1000 AS CLICKS, CAST(COST AS DOUBLE) AS COST,
      CAST(NULL AS DOUBLE) AS CLICK_THROUGH_RATE FROM prd
    UNION ALL SELECT AD_ID, CAST(AD_DATE AS VARCHAR), HEADLINE, CLICKS, CAST(COST AS DOUBLE),
      CAST((CONVERSIONS * 100 + 25) / 10000.0 AS DOUBLE)
    FROM sent s WHERE AD_DATE >= DATE '{AS_OF}' - 30 AND AD_DATE < DATE '{AS_OF}'
      AND NOT EXISTS (SELECT 1 FROM prd p WHERE p.AD_ID = s.AD_ID AND p.AD_DATE = s.AD_DATE)""",
)
def pipe_adwords(spark, sf):
    stored = _before(domain.google_adwords(spark, sf), "AD_DATE").withColumn("CLICKS", F.col("CLICKS") + 1000)
    loaded = adwords.run(
        spark,
        landing.land_csv(adwords_report(spark, sf), "report"),
        new_table(spark, STG_GOOGLE_ADWORDS),
        new_table(spark, GOOGLE_ADWORDS, stored),
        new_rejects(spark),
        AS_OF,
    )
    return loaded.select("AD_ID", "AD_DATE", "HEADLINE", "CLICKS", "COST", "CLICK_THROUGH_RATE")


_STAMP_BASE = 1_514_764_800_000
DAY_MS = 86_400_000


def _stamps(days) -> object:
    at = (F.lit(_STAMP_BASE) + days * DAY_MS).cast("bigint").alias("time")
    return F.struct(F.struct(at).alias("created"), F.struct(at).alias("lastModified")).alias("changeAuditStamps")


def linkedin_landing(spark, sf) -> dict:
    """Nations as accounts, customers as campaigns, orders as creatives, line items as daily metrics."""
    kind = F.when(F.col("n_regionkey") == 0, "PERSONAL").when(F.col("n_regionkey") == 2, "BUSINESS")
    accounts = table(spark, sf, "nation").select(
        F.col("n_nationkey").alias("id"), F.col("n_name").alias("name"), kind.alias("type")
    )
    days = F.col("c_nationkey")
    campaigns = table(spark, sf, "customer").select(
        F.concat(F.lit(linkedin.ACCOUNT_URN), F.col("c_nationkey")).alias("account"),
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("objectiveType"),
        _stamps(days),
        F.lit("CPC").alias("costType"),
        F.struct(F.col("c_acctbal").cast("decimal(18,2)").cast("string").alias("amount")).alias("dailyBudget"),
        F.struct(F.lit("99.50").alias("amount")).alias("totalBudget"),
        F.lit("TEXT_AD").alias("type"),
        F.struct(F.lit("1.25").alias("amount")).alias("unitCost"),
        F.struct((F.lit(_STAMP_BASE) + days * DAY_MS).cast("bigint").alias("start")).alias("runSchedule"),
    )
    creatives = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.concat(F.lit(linkedin.CAMPAIGN_URN), F.col("o_custkey")).alias("campaign"),
        F.when(F.col("o_orderstatus") == "O", "ACTIVE").otherwise("PAUSED").alias("status"),
        _stamps(F.lit(1)),
    )
    shipped = F.col("l_shipdate")
    start = F.struct(
        F.dayofmonth(shipped).alias("day"), F.month(shipped).alias("month"), F.year(shipped).alias("year")
    )
    ads = table(spark, sf, "lineitem").select(
        F.concat(F.lit(linkedin.CREATIVE_URN), F.col("l_orderkey")).alias("creative"),
        F.col("l_quantity").cast("bigint").alias("clicks"),
        F.col("l_extendedprice").cast("decimal(18,2)").cast("string").alias("costInUsd"),
        F.col("l_linenumber").alias("impressions"),
        F.struct(start.alias("start")).alias("dateRange"),
    )
    return {
        "accounts": landing.land_pages(accounts, "elements", "accounts"),
        "campaigns": landing.land_pages(campaigns, "elements", "campaigns"),
        "creatives": landing.land_pages(creatives, "elements", "creatives"),
        "ads": landing.land_pages(ads, "elements", "analytics", ("creative",)),
    }


LINKEDIN_SQL = """WITH sent AS (SELECT o_custkey AS CAMPAIGN_ID, CAST(l_shipdate AS DATE) AS AD_DATE, LEFT(c_name, 4) AS PROGRAM,
      CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS CREATED_DATE, l_orderkey AS CREATIVE_ID,
      CAST(l_quantity AS BIGINT) AS CLICKS, CAST(l_extendedprice AS DECIMAL(18,2)) AS COST, o_orderstatus, n_regionkey
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN customer ON c_custkey = o_custkey
      JOIN nation ON n_nationkey = c_nationkey),
    prd AS (SELECT * FROM sent WHERE AD_DATE < DATE '1995-02-01'),
    kept AS (SELECT * FROM prd WHERE AD_DATE <> (SELECT MAX(AD_DATE) FROM prd))
    SELECT CAMPAIGN_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CAST(NULL AS VARCHAR) AS PROGRAM,
      CAST(NULL AS VARCHAR) AS CREATED_DATE, CREATIVE_ID, CLICKS + 1000 AS CLICKS, CAST(COST AS DOUBLE) AS COST FROM kept
    UNION ALL SELECT CAMPAIGN_ID, CAST(AD_DATE AS VARCHAR), PROGRAM, CAST(CREATED_DATE AS VARCHAR), CREATIVE_ID, CLICKS,
      CAST(COST AS DOUBLE) FROM sent s
    WHERE o_orderstatus = 'O' AND n_regionkey <> 0 AND AD_DATE BETWEEN DATE '1995-02-15' - 150 AND DATE '1995-02-15'
      AND NOT EXISTS (SELECT 1 FROM kept k WHERE k.CAMPAIGN_ID = s.CAMPAIGN_ID AND k.AD_DATE = s.AD_DATE)"""


@check("pipe_linkedin", LINKEDIN_SQL)
def pipe_linkedin(spark, sf):
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    older = (
        table(spark, sf, "lineitem")
        .join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("l_shipdate").cast("date").alias("AD_DATE"),
            F.col("o_custkey").alias("CAMPAIGN_ID"),
            F.col("l_orderkey").alias("CREATIVE_ID"),
            (F.col("l_quantity") + 1000).alias("CLICKS"),
            F.col("l_extendedprice").alias("COST"),
        )
    )
    staging = {
        "campaigns": new_table(spark, STG_LINKEDIN_CAMPAIGNS_UPDATED),
        "creatives": new_table(spark, STG_LINKEDIN_LINK),
        "ads": new_table(spark, STG_LINKEDIN_ADS),
        "batch": new_table(spark, STG_LINKEDIN_ADS_VIEW),
    }
    production = new_table(spark, LINKEDIN_ADS, _before(older, "AD_DATE"))
    loaded = linkedin.run(
        spark, linkedin_landing(spark, sf), staging, production, new_rejects(spark), AS_OF, **LINES
    )
    return loaded.select("CAMPAIGN_ID", "AD_DATE", "PROGRAM", "CREATED_DATE", "CREATIVE_ID", "CLICKS", "COST")


@check(
    "pipe_linkedin_variant",
    """SELECT 'urn:li:sponsoredAccount:' || c_nationkey AS ACCOUNT, c_custkey AS ID, 99.5::DOUBLE AS TOTAL_BUDGET_AMOUNT,
    CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR) AS START_DATE, s.o_custkey AS STORED_ID,
    CAST(s.d AS VARCHAR) AS STORED_CREATED_DATE
    FROM customer JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN (SELECT DISTINCT o_custkey, CAST(o_orderdate AS DATE) AS d FROM orders WHERE o_orderstatus = 'P') s
      ON s.o_custkey = c_custkey WHERE n_regionkey <> 0 AND n_nationkey <> 7""",
)
def pipe_linkedin_variant(spark, sf):
    paths = linkedin_landing(spark, sf)
    accounts = read_pages(spark, paths["accounts"], "elements", linkedin.ACCOUNT, **LINES)
    campaigns = read_pages(spark, paths["campaigns"], "elements", linkedin.CAMPAIGN, **LINES)
    stored = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.col("o_custkey").alias("ID"), F.col("o_orderdate").cast("date").alias("CREATED_DATE"))
    )
    return linkedin.scheduled_campaigns(campaigns, accounts, stored, 7).select(
        "ACCOUNT", "ID", "TOTAL_BUDGET_AMOUNT", "START_DATE", "STORED_ID", "STORED_CREATED_DATE"
    )


# --- surveys and posts ------------------------------------------------------------------


@check(
    "pipe_survey",
    with_("responses")
    + """SELECT RESPONSE_ID, CAST(RESPONSE_DATE AS VARCHAR) AS RESPONSE_DATE, SEGMENT, EMAIL,
      CASE WHEN RESPONSE_DATE < DATE '1999-01-12' THEN ANSWER + 100 ELSE ANSWER END AS ANSWER FROM responses
    WHERE RESPONSE_DATE < DATE '1999-01-15'""",
)
def pipe_survey(spark, sf):
    # Stored up to the 11th; the window of seven days overlaps it.
    as_of = "1999-01-15"
    older = domain.responses(spark, sf).filter(F.col("RESPONSE_DATE") < F.lit("1999-01-12").cast("date"))
    loaded = survey.run(
        spark,
        landing.land_pages(survey_records(spark, sf), "data", "responses"),
        new_table(spark, ASK_NICELY_RESPONSES),
        new_table(spark, ASK_NICELY_RESPONSES, older.withColumn("ANSWER", F.col("ANSWER") + 100)),
        new_rejects(spark),
        as_of,
        **LINES,
    )
    return loaded.select("RESPONSE_ID", "RESPONSE_DATE", "SEGMENT", "EMAIL", "ANSWER")


@check(
    "pipe_social_posts",
    with_("posts")
    + """SELECT POST_ID, CASE WHEN POST_CHANNEL IN ('error', 'view') THEN 'kept'
      WHEN POST_CHANNEL = 'click' THEN 'MSIS' WHEN POST_CHANNEL = 'signup' THEN 'BAPS' ELSE 'CU Online' END AS CAMPAIGN,
    CASE POST_CHANNEL WHEN 'click' THEN 'Facebook' WHEN 'signup' THEN 'LinkedIn' ELSE POST_CHANNEL END AS POST_CHANNEL,
    CASE WHEN POST_CHANNEL IN ('error', 'view') THEN 'first title' ELSE POST_TITLE END AS POST_TITLE,
    CAST(CREATED_DATE AS VARCHAR) AS CREATED_DATE, CLICKS, LIKES, RETWEETS, REPLIES, ITERACTIONS FROM posts""",
)
def pipe_social_posts(spark, sf):
    posts = domain.posts(spark, sf)
    guid = {program: guid for guid, program in lookups.CAMPAIGN_PROGRAMS.items()}
    kind = F.col("POST_CHANNEL")
    channel = F.when(kind == "click", "FacebookPage").when(kind == "signup", "LinkedInCompanyPage").otherwise(kind)
    created = (F.unix_date("CREATED_DATE").cast("bigint") * DAY_MS + (DAY_MS - 1)).cast("string")
    sent = landing.as_text(
        posts.select(
            F.col("POST_ID").alias("broadcastGuid"),
            F.when(kind == "click", guid["MSIS"]).when(kind == "signup", guid["BAPS"]).alias("campaignGuid"),
            F.concat(channel, F.lit(":12345:6")).alias("channelKey"),
            created.alias("createdAt"),
            F.col("POST_TITLE").alias("title"),
            F.col("POST_URL").alias("messageUrl"),
            F.col("CLICKS").alias("clicks"),
            F.col("LIKES").alias("likes"),
            F.col("RETWEETS").alias("retweets"),
            F.col("REPLIES").alias("replies"),
            F.col("ITERACTIONS").alias("interactionsCount"),
        )
    )
    nested = sent.withColumn("content", F.struct("title")).drop("title")
    older = posts.filter(kind.isin("error", "view")).withColumns(
        {"CAMPAIGN": F.lit("kept"), "POST_TITLE": F.lit("first title"), "CLICKS": F.lit(0), "REPLIES": F.lit(None)}
    )
    loaded = social_posts.run(
        spark,
        landing.land_arrays(nested, "broadcasts"),
        new_table(spark, STG_HUBSPOT_SOCIAL_POSTS),
        new_table(spark, HUBSPOT_SOCIAL_POSTS, older),
        new_rejects(spark),
        **LINES,
    )
    return loaded.drop("POST_URL")


# --- contacts ---------------------------------------------------------------------------

# Local noon of a day in January 2018, per nation.
_MODIFIED = _STAMP_BASE + 19 * 3_600_000


def _modified_ms():
    return F.lit(_MODIFIED) + F.col("c_nationkey") * DAY_MS


def contact_ids(spark, sf) -> str:
    """Pages of contact ids from all customers."""
    value = lambda c: F.struct(c.cast("string").alias("value"))
    properties = F.create_map(
        F.lit("firstname"),
        value(F.col("c_mktsegment")),
        F.lit("lastname"),
        value(F.col("c_name")),
        F.lit("lastmodifieddate"),
        value(_modified_ms()),
    )
    sent = table(spark, sf, "customer").select(F.col("c_custkey").alias("vid"), properties.alias("properties"))
    return landing.land_pages(sent, "contacts", "contact_ids")


VERSIONS = "array<struct<value:string,timestamp:bigint>>"


def profiles(spark, sf) -> str:
    """One profile document per customer."""
    none = F.lit(None).cast(VERSIONS)

    def entry(col, versions=none):
        return F.struct(col.cast("string").alias("value"), versions.alias("versions"))

    stage = F.array(
        F.struct(F.col("c_mktsegment").alias("value"), _modified_ms().cast("bigint").alias("timestamp")),
        F.struct(F.lit("older").alias("value"), F.lit(1).cast("bigint").alias("timestamp")),
    )
    values = {
        "firstname": entry(F.col("c_mktsegment")),
        "lastname": entry(F.col("c_name")),
        "createdate": entry(F.lit(_STAMP_BASE)),
        "birthdate": entry(F.lit(-DAY_MS)),
        "lifecyclestage": entry(F.col("c_mktsegment"), stage),
        "recent_conversion_event_name": entry(
            F.lit("form"), F.when(F.col("c_acctbal") >= 0, stage).otherwise(F.array().cast(VERSIONS))
        ),
        "hs_analytics_num_page_views": entry(F.col("c_nationkey")),
        "email": entry(F.lower("c_name")),
        "cu_email_address": entry(F.when(F.col("c_acctbal") < 0, "").otherwise(F.col("c_name"))),
        "lastmodifieddate": entry(_modified_ms()),
        "academic_program": entry(F.expr(domain.PROGRAM_LIST)),
    }
    properties = F.create_map(*[part for name, col in values.items() for part in (F.lit(name), col)])
    form = F.struct(F.col("c_name").alias("title"), _modified_ms().cast("bigint").alias("timestamp"))
    second = F.struct(F.lit("again").alias("title"), F.lit(_STAMP_BASE).cast("bigint").alias("timestamp"))
    forms = (
        F.when(F.col("c_acctbal") >= 5000, F.array(form, second))
        .when(F.col("c_acctbal") >= 0, F.array(form))
        .otherwise(F.array().cast("array<struct<title:string,timestamp:bigint>>"))
    )
    docs = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("vid"), properties.alias("properties"), forms.alias("form-submissions")
    )
    return landing.land_documents(docs, "profiles")


# Stored contacts are those of the first eleven nations; the newest of them are replaced.
@check(
    "pipe_contacts",
    with_("programs")
    + """SELECT c_custkey AS VID, c_name AS LAST_NAME, 'OLD' AS ACADEMIC_PROGRAM, CAST(NULL AS VARCHAR) AS CREATED_DATE,
      CAST(NULL AS VARCHAR) AS LIFECYCLE_STAGE_DATE, CAST(NULL AS VARCHAR) AS CONVERSION_NAME,
      CAST(NULL AS VARCHAR) AS CONVERSION_DATE, CAST(NULL AS BIGINT) AS NUM_PAGE_VIEWS, CAST(NULL AS VARCHAR) AS CU_EMAIL,
      CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR) AS LAST_MODIFIED_DATE,
      CAST(NULL AS VARCHAR) AS IMPORT_DATE FROM customer WHERE c_nationkey < 10
    UNION ALL SELECT c_custkey, c_name, ACADEMIC_PROGRAM, '2017-12-31',
      CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR),
      CASE WHEN c_acctbal >= 0 THEN c_mktsegment END,
      CASE WHEN c_acctbal >= 0 THEN CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR) END,
      CAST(c_nationkey AS BIGINT), CASE WHEN c_acctbal >= 0 THEN c_name END,
      CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR), '2018-02-01'
    FROM customer JOIN programs p ON p.VID = c_custkey WHERE c_nationkey >= 10""",
)
def pipe_contacts(spark, sf):
    day = F.date_add(F.lit("2018-01-01").cast("date"), F.col("c_nationkey"))
    older = (
        table(spark, sf, "customer")
        .filter(F.col("c_nationkey") <= 10)
        .select(
            F.col("c_custkey").alias("VID"),
            F.col("c_name").alias("LAST_NAME"),
            F.lit("OLD").alias("ACADEMIC_PROGRAM"),
            day.alias("LAST_MODIFIED_DATE"),
        )
    )
    staging = {
        "ids": new_table(spark, STG_HUBSPOT_CONTACTS),
        "info": new_table(spark, STG_HUBSPOT_CONTACTS_INFO),
        "programs": new_table(spark, STG_HUBSPOT_PROGRAMS),
        "batch": new_table(spark, STG_HUBSPOT_CONTACTS_VIEW),
    }
    loaded = contacts.run(
        spark,
        {"ids": contact_ids(spark, sf), "profiles": profiles(spark, sf)},
        staging,
        new_table(spark, HUBSPOT_CONTACTS, older),
        new_rejects(spark),
        "2018-02-01",
        LOCAL,
        **LINES,
    )
    return loaded.select(
        "VID",
        "LAST_NAME",
        "ACADEMIC_PROGRAM",
        "CREATED_DATE",
        "LIFECYCLE_STAGE_DATE",
        "CONVERSION_NAME",
        "CONVERSION_DATE",
        "NUM_PAGE_VIEWS",
        "CU_EMAIL",
        "LAST_MODIFIED_DATE",
        "IMPORT_DATE",
    )


@check(
    "pipe_contacts_initial",
    """SELECT c_custkey AS VID, c_mktsegment AS FIRST_NAME, c_name AS LAST_NAME,
    CAST(CAST(DATE '2018-01-01' + c_nationkey AS DATE) AS VARCHAR) AS MODIFIED_DATE FROM customer""",
)
def pipe_contacts_initial(spark, sf):
    return contacts.run_initial(
        spark, contact_ids(spark, sf), new_table(spark, STG_HUBSPOT_CONTACTS), new_rejects(spark), **LINES
    )


_MODIFIED_SQL = f"({_MODIFIED} + CAST(c_nationkey AS BIGINT) * {DAY_MS})"


# Stored: nations up to 15, as they were on the 10th; later changes are modifications.
@check(
    "pipe_contacts_legacy_cdc",
    with_("programs")
    + f""", state AS (SELECT c.*, CASE WHEN c_nationkey > 15 THEN 'new'
      WHEN {_local(_MODIFIED_SQL)} > '2018-01-10 00:00:00' THEN 'modified' ELSE 'unchanged' END AS st FROM customer c)
    SELECT 'contact' AS T, c_custkey AS VID, CASE WHEN st = 'unchanged' THEN 'OLD' ELSE c_name END AS LAST_NAME,
      CASE WHEN st = 'unchanged' THEN '2018-01-10 00:00:00' ELSE {_local(_MODIFIED_SQL)} END AS UPDATED_AT,
      CASE WHEN st <> 'unchanged' THEN '1969-12-30 17:00:00' END AS BIRTHDATE FROM state
    UNION ALL SELECT 'program', c_custkey, 'OLD', NULL, NULL FROM state WHERE st = 'unchanged'
    UNION ALL SELECT 'program', c_custkey, ACADEMIC_PROGRAM, NULL, NULL FROM state JOIN programs p ON p.VID = c_custkey
      WHERE st <> 'unchanged'""",
)
def pipe_contacts_legacy_cdc(spark, sf):
    known = table(spark, sf, "customer").filter(F.col("c_nationkey") <= 15)
    vid = F.col("c_custkey").alias("VID")
    stored = new_table(
        spark,
        contacts_legacy.HS_CONTACTS,
        known.select(vid, F.lit("OLD").alias("LAST_NAME"), F.lit("2018-01-10 00:00:00").alias("UPDATED_AT")),
    )
    programs = new_table(
        spark, contacts_legacy.HS_CONTACT_PROGRAM, known.select(vid, F.lit("OLD").alias("ACADEMIC_PROGRAM"))
    )
    landed = {"ids": contact_ids(spark, sf), "profiles": profiles(spark, sf)}
    people, listed = contacts_legacy.run(spark, landed, stored, programs, "2018-02-01 00:00:00", LOCAL, **LINES)
    none = F.lit(None).cast("string")
    return people.select(F.lit("contact").alias("T"), "VID", "LAST_NAME", "UPDATED_AT", "BIRTHDATE").unionByName(
        listed.select(
            F.lit("program").alias("T"),
            "VID",
            F.col("ACADEMIC_PROGRAM").alias("LAST_NAME"),
            none.alias("UPDATED_AT"),
            none.alias("BIRTHDATE"),
        )
    )


@check(
    "pipe_contact_forms",
    f"""WITH due AS (SELECT *, c_nationkey > 12 OR c_nationkey < 5 AS stale FROM customer)
    SELECT c_custkey AS VID, 'OLD' AS FORM, CAST(NULL AS VARCHAR) AS FORM_DATE,
      CASE WHEN c_nationkey < 5 THEN '2018-01-20' ELSE '2018-01-01' END || ' 00:00:00' AS UPDATEDAT FROM due WHERE NOT stale
    UNION ALL SELECT c_custkey, c_name, {_local(_MODIFIED_SQL)}, '2018-02-01 00:00:00' FROM due
      WHERE stale AND c_acctbal >= 0
    UNION ALL SELECT c_custkey, 'again', '2017-12-31 17:00:00', '2018-02-01 00:00:00' FROM due
      WHERE stale AND c_acctbal >= 5000""",
)
def pipe_contact_forms(spark, sf):
    people = table(spark, sf, "customer")
    vid = F.col("c_custkey").alias("VID")
    stored = new_table(
        spark, contacts_legacy.HS_CONTACTS, people.select(vid, F.lit("2018-01-10 00:00:00").alias("UPDATED_AT"))
    )
    seen = F.when(F.col("c_nationkey") < 5, "2018-01-20 00:00:00").otherwise("2018-01-01 00:00:00")
    older = people.filter(F.col("c_nationkey") <= 12).select(vid, F.lit("OLD").alias("FORM"), seen.alias("UPDATEDAT"))
    forms = new_table(spark, contacts_legacy.HS_CONTACT_FORMS, older)
    return contacts_legacy.run_forms(
        spark, profiles(spark, sf), stored, forms, "2018-02-01 00:00:00", LOCAL, **LINES
    )


# --- engagements, workflows, email campaigns ------------------------------------------------


def _with_rejected(loaded, rejects, word: str):
    """Stored rows, and what stands as the id of the rejected ones."""
    found = rejects.read().select(F.regexp_extract("CSV_DATA", f"{word} [0-9]+", 0).alias("REJECTED"))
    return loaded.unionByName(found, allowMissingColumns=True)


@check(
    "pipe_engagements",
    f"""SELECT CAST(NULLIF(event_id, 0) AS VARCHAR) AS ENGAGEMENT_ID, CASE WHEN user_id > 20 THEN 'true' END AS ACTIVE,
    {_local("epoch_us(ts) // 1000")} AS CREATED_AT, event_type AS TYPE,
    CASE WHEN event_type = 'click' THEN CAST(user_id AS VARCHAR) END AS CONTACT_ID,
    CASE WHEN event_type = 'view' THEN 'to' || user_id || '@example.org' END AS TO_EMAIL,
    'line onetwo' || props AS BODY,
    CASE WHEN event_type = 'signup' THEN {_local("epoch_us(ts) // 1000 + 60000")} END AS REMINDER,
    CAST(NULL AS VARCHAR) AS SUBJECT, CAST(NULLIF(user_id, 0) AS VARCHAR) AS OWNER_ID, CAST(NULL AS VARCHAR) AS REJECTED
    FROM events WHERE event_id % 100 <> 42
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'event ' || event_id
    FROM events WHERE event_id % 100 = 42""",
)
def pipe_engagements(spark, sf):
    """Pages of a hundred engagements, one of them with a text as its id: that one goes to the rejects."""
    kind, at = F.col("event_type"), domain.millis("ts")
    longs = "array<bigint>"
    person = F.struct(F.concat(F.lit("to"), F.col("user_id"), F.lit("@example.org")).alias("email"))
    sent = table(spark, sf, "events").select(
        "event_id",
        F.struct(
            F.col("event_id").alias("id"),
            (F.col("user_id") > 20).alias("active"),
            at.alias("createdAt"),
            kind.alias("type"),
            F.col("user_id").alias("ownerId"),
        ).alias("engagement"),
        F.struct(
            F.when(kind == "click", F.array("user_id")).otherwise(F.array().cast(longs)).alias("contactIds")
        ).alias("associations"),
        F.struct(
            F.when(kind == "view", F.array(person)).alias("to"),
            F.concat(F.lit("line <p>one\n\r<p>two"), F.col("props")).alias("body"),
            F.when(kind == "signup", F.array(at + 60_000)).alias("reminders"),
            F.lit("").alias("subject"),
        ).alias("metadata"),
    )
    path = landing.land_with_faults(sent, "event_id", "event", "results", "engagements")
    stored, rejects = new_table(spark, engagement.HS_CONTACT_ENGAGEMENTS), new_rejects(spark)
    loaded = engagement.run_engagements(spark, path, stored, LOCAL, rejects=rejects, **LINES)
    return _with_rejected(loaded, rejects, "event").select(
        "ENGAGEMENT_ID",
        "ACTIVE",
        "CREATED_AT",
        "TYPE",
        "CONTACT_ID",
        "TO_EMAIL",
        "BODY",
        "REMINDER",
        "SUBJECT",
        "OWNER_ID",
        "REJECTED",
    )


@check(
    "pipe_contact_workflow",
    f"""SELECT c_custkey AS VID, n AS TRIGGER_ID, c_mktsegment AS TRIGGER_TYPE,
    CASE WHEN n = 2 THEN 'true' END AS ENROLL_ON_ACTIVATION, CAST(c_nationkey + 1 AS BIGINT) AS WORKFLOW_ID,
    {_local(_MODIFIED_SQL)} AS INSERTED_AT, c_name AS NAME, 'step' AS STEP_ID, '9' AS STEP_FILTERS_LIST_ID
    FROM customer, (SELECT UNNEST([1, 2])::BIGINT AS n) WHERE c_acctbal >= 0""",
)
def pipe_contact_workflow(spark, sf, all_entries=False):
    def trigger(n):
        first = F.struct(
            F.lit(n).alias("id"), F.col("c_mktsegment").alias("type"), F.lit(n == 2).alias("enrollContactsOnActivation")
        )
        return F.struct(F.array(first).alias("trigger"))

    flow = F.struct(
        (F.col("c_nationkey") + 1).alias("id"),
        _modified_ms().cast("bigint").alias("insertedAt"),
        F.col("c_name").alias("name"),
        F.when(F.col("c_acctbal") >= 0, F.array(trigger(1), trigger(2))).otherwise(F.array()).alias("triggerSet"),
        F.struct(F.lit("step").alias("id"), F.struct(F.lit("9").alias("filtersListId")).alias("branchCondition")).alias(
            "steps"
        ),
    )
    docs = table(spark, sf, "customer").select(F.col("c_custkey").alias("vid"), F.array(flow, flow).alias("workflows"))
    landed = {"ids": contact_ids(spark, sf), "enrolments": landing.land_documents(docs, "enrolments")}
    stored = new_table(spark, engagement.HS_CONTACT_WORKFLOW)
    return engagement.run_workflows(spark, landed, stored, LOCAL, all_entries=all_entries, **LINES).select(
        "VID",
        "TRIGGER_ID",
        "TRIGGER_TYPE",
        "ENROLL_ON_ACTIVATION",
        "WORKFLOW_ID",
        "INSERTED_AT",
        "NAME",
        "STEP_ID",
        "STEP_FILTERS_LIST_ID",
    )


@check(
    "pipe_contact_workflow_all",
    f"SELECT * FROM ({ORACLE['pipe_contact_workflow']}) UNION ALL SELECT * FROM ({ORACLE['pipe_contact_workflow']})",
)
def pipe_contact_workflow_all(spark, sf):
    """Both workflows of each contact, which are alike."""
    return pipe_contact_workflow(spark, sf, all_entries=True)


@check(
    "pipe_engagement_entries",
    """SELECT CAST(event_id AS VARCHAR) AS ENGAGEMENT_ID, 'CONTACT_ID' AS ENTRY, n AS POSITION,
    CAST(user_id + n AS VARCHAR) AS VALUE FROM events, (SELECT UNNEST([0, 1, 2])::BIGINT AS n) WHERE n <= user_id % 3
    UNION ALL SELECT CAST(event_id AS VARCHAR), 'TO_EMAIL', 0, event_type || '@example.org' FROM events
    WHERE event_type <> 'view'""",
)
def pipe_engagement_entries(spark, sf):
    """Events as engagements with one to three contacts and at most one recipient."""
    user = F.col("user_id")
    person = F.struct(F.concat(F.col("event_type"), F.lit("@example.org")).alias("email"))
    sent = table(spark, sf, "events").select(
        F.struct(F.col("event_id").alias("id")).alias("engagement"),
        F.struct(F.transform(F.sequence(F.lit(0), (user % 3).cast("int")), lambda n: user + n).alias("contactIds")).alias(
            "associations"
        ),
        F.struct(F.when(F.col("event_type") != "view", F.array(person)).alias("to")).alias("metadata"),
    )
    entries = new_table(spark, engagement.HS_ENGAGEMENT_ENTRIES)
    stored = new_table(spark, engagement.HS_CONTACT_ENGAGEMENTS)
    engagement.run_engagements(
        spark, landing.land_pages(sent, "results", "engagements"), stored, LOCAL, entries=entries, **LINES
    )
    return entries.read()


@check(
    "pipe_email_campaigns",
    f"""SELECT o_orderkey AS ID, o_custkey AS APP_ID, o_orderpriority AS SUBJECT,
    NULLIF(CAST(EXTRACT(DAY FROM o_orderdate) AS BIGINT) - 1, 0) AS SENT,
    CAST(EXTRACT(MONTH FROM o_orderdate) AS BIGINT) AS OPEN, o_orderstatus AS PROCESSING_STATE,
    {_local("date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) * 86400000")} AS LAST_PROCESSING_FINISHED_AT
    FROM orders WHERE o_orderstatus <> 'P'""",
)
def pipe_email_campaigns(spark, sf):
    orders = table(spark, sf, "orders")
    key = [F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("appId")]
    listed = orders.filter(F.col("o_orderstatus") != "P").select(*key)
    details = orders.select(
        *key,
        F.col("o_orderpriority").alias("subject"),
        F.struct(
            (F.dayofmonth("o_orderdate") - 1).alias("sent"), F.month("o_orderdate").alias("open")
        ).alias("counters"),
        F.col("o_orderstatus").alias("processingState"),
        (F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint") * DAY_MS).alias("lastProcessingFinishedAt"),
    )
    landed = {
        "ids": landing.land_pages(listed, "campaigns", "campaign_ids"),
        "details": landing.land_documents(details, "campaigns"),
    }
    stored = new_table(spark, engagement.HS_CAMPAIGNS)
    return engagement.run_campaigns(spark, landed, stored, LOCAL, **LINES).select(
        "ID", "APP_ID", "SUBJECT", "SENT", "OPEN", "PROCESSING_STATE", "LAST_PROCESSING_FINISHED_AT"
    )


# --- content -----------------------------------------------------------------------------


def _reload(spark, sent, listing):
    path = landing.land_pages(sent, listing.record_path, listing.contract.name.lower())
    return content.run(spark, path, listing, new_table(spark, listing.contract), LOCAL, **LINES)


@check(
    "pipe_blogs",
    f"""SELECT url AS ABSOLUTE_URL, CAST(page_id AS VARCHAR) AS ANALYTICS_PAGE_ID, CAST(NULL AS BIGINT) AS CATEGORY_ID,
    {_local(f"{_STAMP_BASE} + page_id * 1000")} AS CREATED_AT, html AS HTML_TITLE, NULLIF(page_id, 0) AS ID,
    CAST(3 AS BIGINT) AS PORTAL_ID, CAST(NULL AS VARCHAR) AS REJECTED FROM pages WHERE page_id % 100 <> 42
    UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'page ' || page_id FROM pages WHERE page_id % 100 = 42""",
)
def pipe_blogs(spark, sf):
    """Pages of a hundred blogs, one of them with a text as its id: that one goes to the rejects."""
    sent = table(spark, sf, "pages").select(
        F.col("url").alias("absolute_url"),
        F.col("page_id").cast("string").alias("analytics_page_id"),
        F.lit(0).alias("category_id"),
        (F.col("page_id") * 1000 + _STAMP_BASE).alias("created_date_time"),
        F.col("html").alias("html_title"),
        F.col("page_id").alias("id"),
        F.lit(3).alias("portal_id"),
        "page_id",
    )
    path = landing.land_with_faults(sent, "page_id", "page", "objects", "blogs")
    stored, rejects = new_table(spark, content.BLOGS.contract), new_rejects(spark)
    return _with_rejected(content.run(spark, path, content.BLOGS, stored, LOCAL, rejects, **LINES), rejects, "page")


@check(
    "pipe_blog_posts",
    f"""SELECT CAST(doc_id AS VARCHAR) AS ANALYTICS_PAGE_ID, source AS AUTHOR,
    {_local(f"{_STAMP_BASE} + doc_id * 1000")} AS AUTHOR_AT, NULLIF(n_chars, 0) AS COMMENT_COUNT,
    CASE WHEN lang = 'en' THEN 'true' END AS CURRENTLY_PUBLISHED, NULLIF(text, '') AS HTML_TITLE, lang AS LABEL
    FROM documents""",
)
def pipe_blog_posts(spark, sf):
    sent = table(spark, sf, "documents").select(
        F.col("doc_id").cast("string").alias("analytics_page_id"),
        F.col("source").alias("author"),
        (F.col("doc_id") * 1000 + _STAMP_BASE).alias("author_at"),
        F.col("n_chars").alias("comment_count"),
        (F.col("lang") == "en").alias("currently_published"),
        F.col("text").alias("html_title"),
        F.col("lang").alias("label"),
    )
    loaded = _reload(spark, sent, content.BLOG_POSTS)
    return loaded.select(
        "ANALYTICS_PAGE_ID", "AUTHOR", "AUTHOR_AT", "COMMENT_COUNT", "CURRENTLY_PUBLISHED", "HTML_TITLE", "LABEL"
    )


@check(
    "pipe_keywords",
    f"""SELECT p_name AS KEYWORD, p_brand AS COUNTRY, NULLIF(p_partkey, 0) AS VISITS, CAST(p_size AS BIGINT) AS CONTACTS,
    CAST(NULL AS BIGINT) AS LEADS, {_local(f"{_STAMP_BASE} + p_partkey * 1000")} AS CREATED_AT FROM part""",
)
def pipe_keywords(spark, sf):
    sent = table(spark, sf, "part").select(
        F.col("p_name").alias("keyword"),
        F.col("p_brand").alias("country"),
        F.col("p_partkey").alias("visits"),
        F.col("p_size").alias("contacts"),
        F.lit(0).alias("leads"),
        (F.col("p_partkey") * 1000 + _STAMP_BASE).alias("created_at"),
    )
    return _reload(spark, sent, content.KEYWORDS)


@check(
    "pipe_workflows",
    f"""SELECT s_name AS NAME, NULLIF(s_suppkey, 0) AS ID, 'DRIP' AS TYPE, CASE WHEN s_acctbal > 0 THEN 'true' END AS ENABLED,
    {_local(f"{_STAMP_BASE} + s_suppkey * 1000")} AS INSERTED_AT, CAST(NULL AS VARCHAR) AS UPDATED_AT,
    NULLIF(CAST(s_nationkey AS BIGINT), 0) AS LIST_ENROLLED, CAST(5 AS BIGINT) AS LIST_ACTIVE,
    CAST(6 AS BIGINT) AS COUNT_ACTIVE, CAST(NULL AS BIGINT) AS COUNT_ENROLLED, CAST(NULL AS VARCHAR) AS FIRST_STEPS,
    CAST(NULL AS VARCHAR) AS SECOND_STEPS FROM supplier""",
)
def pipe_workflows(spark, sf):
    sent = table(spark, sf, "supplier").select(
        F.col("s_name").alias("name"),
        F.col("s_suppkey").alias("id"),
        F.lit("DRIP").alias("type"),
        (F.col("s_acctbal") > 0).alias("enabled"),
        (F.col("s_suppkey") * 1000 + _STAMP_BASE).alias("insertedAt"),
        F.struct(F.col("s_nationkey").alias("enrolled"), F.lit(5).alias("active")).alias("contactListIds"),
        F.struct(F.lit(6).alias("active"), F.lit(0).alias("enrolled")).alias("contactCounts"),
    )
    return _reload(spark, sent, content.WORKFLOWS)


# --- web analytics ---------------------------------------------------------------------------


def _report(spark, rows, report, name):
    """Land rows of a report one per page, load them, and return the stored table."""
    matrix = rows.select(F.array(F.array(*[F.col(c).cast("string") for c in rows.columns])).alias("rows"))
    path = landing.land_documents(matrix, name)
    return web_analytics.run(spark, path, report, new_table(spark, report[0]), new_rejects(spark), **LINES)


@check(
    "pipe_ga_campaigns",
    """SELECT l_returnflag || l_linestatus AS CAMPAIGN, CASE WHEN l_linestatus <> 'F' THEN l_linestatus END AS SOURCE,
    CAST(NULL AS VARCHAR) AS AD_GROUP, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS REPORT_DATE,
    CAST(l_suppkey AS VARCHAR) AS ADWORDS_CAMPAIGN_ID, CAST(l_quantity AS BIGINT) AS IMPRESSIONS,
    CAST(l_linenumber AS BIGINT) AS AD_CLICKS, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS AD_COST,
    CAST(CAST(l_tax AS DECIMAL(18,2)) AS DOUBLE) AS COST_PER_CONVERSION FROM lineitem""",
)
def pipe_ga_campaigns(spark, sf):
    zero = F.lit("0")
    rows = table(spark, sf, "lineitem").select(
        F.concat("l_returnflag", F.lit("|"), "l_linestatus", F.lit("(not set)")).alias("c0"),
        F.when(F.col("l_linestatus") == "F", "(direct)").otherwise(F.col("l_linestatus")).alias("c1"),
        F.lit("(not set)").alias("c2"),
        F.replace(F.col("l_shipdate").cast("date").cast("string"), F.lit("-"), F.lit("")).alias("c3"),
        F.col("l_suppkey").alias("c4"),
        F.col("l_quantity").cast("bigint").alias("c5"),
        F.col("l_linenumber").alias("c6"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("c7"),
        *[zero.alias(f"c{i}") for i in range(8, 13)],
        F.col("l_tax").cast("decimal(18,2)").alias("c13"),
    )
    loaded = _report(spark, rows, web_analytics.CAMPAIGNS, "ga_campaigns")
    return loaded.select(
        "CAMPAIGN",
        "SOURCE",
        "AD_GROUP",
        "REPORT_DATE",
        "ADWORDS_CAMPAIGN_ID",
        "IMPRESSIONS",
        "AD_CLICKS",
        "AD_COST",
        "COST_PER_CONVERSION",
    )


@check(
    "pipe_ga_pages",
    """SELECT NULLIF(SPLIT_PART(url, '/', 3), '') AS PAGE_PATH_LEVEL1, CAST(NULL AS VARCHAR) AS PAGE_PATH_LEVEL2,
    html AS PAGE_TITLE, url AS LANDING_PAGE_PATH, page_id AS PAGEVIEWS, CAST(1.5 AS DOUBLE) AS TIME_ON_PAGE,
    CAST(NULL AS BIGINT) AS EXITS FROM pages""",
)
def pipe_ga_pages(spark, sf):
    unset = F.lit("(not set)")
    # The last metric is missing from every row.
    rows = table(spark, sf, "pages").select(
        F.split_part("url", F.lit("/"), F.lit(3)).alias("c0"),
        *[unset.alias(f"c{i}") for i in (1, 2, 3)],
        F.concat(unset, "html").alias("c4"),
        F.col("url").alias("c5"),
        unset.alias("c6"),
        F.col("page_id").alias("c7"),
        F.lit(1).alias("c8"),
        F.lit("1.5").alias("c9"),
    )
    loaded = _report(spark, rows, web_analytics.PAGES, "ga_pages")
    return loaded.select(
        "PAGE_PATH_LEVEL1",
        "PAGE_PATH_LEVEL2",
        "PAGE_TITLE",
        "LANDING_PAGE_PATH",
        "PAGEVIEWS",
        "TIME_ON_PAGE",
        "EXITS",
    )


@check(
    "pipe_ga_devices",
    """SELECT event_type AS OPERATING_SYSTEM, CAST(user_id AS VARCHAR) AS DEVICE_CATEGORY,
    CAST(NULL AS VARCHAR) AS MOBILE_DEVICE_BRANDING, event_id AS PAGEVIEWS FROM events""",
)
def pipe_ga_devices(spark, sf):
    rows = table(spark, sf, "events").select(
        F.concat("event_type", F.lit("(not set)")).alias("c0"),
        F.col("user_id").alias("c1"),
        F.lit("(not set)").alias("c2"),
        F.col("event_id").alias("c3"),
    )
    return _report(spark, rows, web_analytics.DEVICES, "ga_devices")


@check(
    "pipe_ga_traffic",
    """SELECT o_orderpriority AS FULL_REFERRER, CAST(NULL AS VARCHAR) AS CAMPAIGN,
    CAST(o_custkey AS VARCHAR) AS ADWORDS_CAMPAIGN_ID, CAST(NULL AS VARCHAR) AS KEYWORD,
    CAST(NULL AS VARCHAR) AS SOCIAL_NETWORK, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS MEDIUM,
    CASE WHEN o_orderstatus = 'F' THEN 'direct' ELSE o_orderstatus END AS SOURCE, o_orderkey AS ORGANIC_SEARCHES
    FROM orders""",
)
def pipe_ga_traffic(spark, sf):
    status, unset = F.col("o_orderstatus"), F.lit("(not set)")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("c0"),
        unset.alias("c1"),
        F.col("o_custkey").alias("c2"),
        unset.alias("c3"),
        unset.alias("c4"),
        F.when(status == "O", "(none)").otherwise(status).alias("c5"),
        F.when(status == "F", "(direct)").otherwise(status).alias("c6"),
        F.col("o_orderkey").alias("c7"),
    )
    return _report(spark, rows, web_analytics.TRAFFIC, "ga_traffic")
