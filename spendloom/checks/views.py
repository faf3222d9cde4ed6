"""Reporting views."""

from __future__ import annotations

from spendloom.checks import domain
from spendloom.checks.domain import with_
from spendloom.checks.registry import check
from spendloom.contracts.tables import COURSE_LISTS_PRD
from spendloom.plans import views

_RATIOS = """CASE WHEN {clicks} = 0 OR IMPRESSIONS = 0 THEN 0.0
  ELSE ((2 * {clicks} * 1000 + IMPRESSIONS) // (2 * IMPRESSIONS)) / 1000.0 END AS CLICKS_PER_IMPRESSIONS,
  CASE WHEN {cost} = 0 OR {clicks} = 0 THEN 0.0
  ELSE ((2 * CAST({cost} * 100 AS BIGINT) + {clicks}) // (2 * {clicks})) / 100.0 END AS COST_PER_CLICK"""

DAILY_SPEND = f"""
SELECT 'Paid' AS PAID_SOCIAL, 'Google Adwords' AS MARKETING_PLATFORM, CAST(AD_DATE AS VARCHAR) AS AD_DATE,
  CASE WHEN CAMPAIGN_NAME IN ('Master Criminal Justice MCJ', 'MC J') THEN 'MCJ' ELSE CAMPAIGN_NAME END AS PROGRAM,
  ADGROUP_NAME AS CAMPAIGN, HEADLINE, DESCRIPTION, CAST(AD_ID AS VARCHAR) AS AD_ID, CLICKS, CONVERSIONS,
  CAST(COST AS DOUBLE) AS COST, IMPRESSIONS, {_RATIOS.format(clicks="CLICKS", cost="COST")}
FROM google_adwords WHERE IMPRESSIONS > 0
UNION ALL
SELECT 'Paid', 'LinkedIn', CAST(AD_DATE AS VARCHAR),
  CASE WHEN PROGRAM IN ('Master Criminal Justice MCJ', 'MC J') THEN 'MCJ'
       WHEN PROGRAM IN ('CUON', 'CU Online') THEN 'CU Online' ELSE PROGRAM END,
  CAMPAIGN_NAME, CAMPAIGN_NAME, NULL, CAST(CREATIVE_ID AS VARCHAR), CLICKS, NULL,
  CAST(COST AS DOUBLE), IMPRESSIONS, {_RATIOS.format(clicks="CLICKS", cost="COST")}
FROM linkedin_ads WHERE IMPRESSIONS > 0
UNION ALL
SELECT 'Paid', 'Facebook', CAST(AD_DATE AS VARCHAR),
  CASE WHEN PROGRAM_NAME = 'CUON' THEN 'CU Online'
       WHEN PROGRAM_NAME IN ('Master Criminal Justice MCJ', 'M CJ') THEN 'MCJ' ELSE PROGRAM_NAME END,
  ADSET_NAME, ADSET_NAME, NULL, CAST(AD_ID AS VARCHAR), CLICKS, TOTAL_ACTIONS,
  CAST(SPEND AS DOUBLE), IMPRESSIONS, {_RATIOS.format(clicks="CLICKS", cost="SPEND")}
FROM facebook_ads WHERE IMPRESSIONS > 0
UNION ALL
SELECT 'Social', POST_CHANNEL, CAST(CREATED_DATE AS VARCHAR), CAMPAIGN, CAMPAIGN, POST_TITLE, POST_TITLE,
  POST_ID, CLICKS, NULL, NULL, ITERACTIONS, NULL, NULL
FROM posts
"""
_SPEND_TABLES = ("google_adwords", "linkedin_ads", "facebook_ads", "posts")


@check("view_daily_spend", with_(*_SPEND_TABLES) + DAILY_SPEND)
def daily_spend(spark, sf):
    return views.daily_spend(domain.spend_tables(spark, sf))


@check(
    "view_daily_spend_by_program",
    with_(*_SPEND_TABLES, spend=DAILY_SPEND)
    + """SELECT MARKETING_PLATFORM, PROGRAM, COUNT(*) AS AD_DAYS, CAST(SUM(CLICKS) AS BIGINT) AS CLICKS,
    CAST(SUM(IMPRESSIONS) AS BIGINT) AS IMPRESSIONS,
    CAST(SUM(CAST(COST AS DECIMAL(18,2))) AS DOUBLE) AS COST
    FROM spend GROUP BY MARKETING_PLATFORM, PROGRAM""",
)
def spend_by_program(spark, sf):
    return views.spend_by_program(domain.spend_tables(spark, sf))


LINKEDIN_VIEW = """SELECT CAST(DATE '2018-08-01' AS VARCHAR) AS AD_DATE, o_orderkey AS CAMPAIGN_ID,
  LEFT(o_orderpriority, 4) AS PROGRAM, o_orderpriority AS CAMPAIGN_NAME,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS CREATED_DATE, o_orderstatus AS COST_TYPE,
  CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS DOUBLE) AS DAILY_BUDGET, p_partkey AS CREATIVE_ID,
  CAST(p_size AS BIGINT) AS CLICKS, CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS DOUBLE) AS COST,
  CAST(p_size AS BIGINT) * 10 AS IMPRESSIONS
FROM lineitem JOIN orders ON o_orderkey = l_orderkey JOIN part ON p_partkey = l_partkey"""
_LINKEDIN_COLUMNS = (
    "AD_DATE",
    "CAMPAIGN_ID",
    "PROGRAM",
    "CAMPAIGN_NAME",
    "CREATED_DATE",
    "COST_TYPE",
    "DAILY_BUDGET",
    "CREATIVE_ID",
    "CLICKS",
    "COST",
    "IMPRESSIONS",
)


@check("view_linkedin_ads", LINKEDIN_VIEW)
def linkedin_ads(spark, sf):
    return views.linkedin_ads(domain.linkedin_staging(spark, sf)).select(*_LINKEDIN_COLUMNS)


_CONTACT_COLUMNS = (
    "VID",
    "FIRST_NAME",
    "LAST_NAME",
    "ACADEMIC_PROGRAM",
    "LIFECYCLE_STAGE",
    "NUM_PAGE_VIEWS",
    "PHONE",
    "EMAIL",
    "CU_EMAIL",
    "LEAD_STATUS",
    "LAST_MODIFIED_DATE",
)
CONTACTS_VIEW = (
    with_("info", "programs")
    + """SELECT i.VID, FIRST_NAME, LAST_NAME, ACADEMIC_PROGRAM, LIFECYCLE_STAGE, NUM_PAGE_VIEWS, PHONE, EMAIL,
  CU_EMAIL, LEAD_STATUS, CAST(LAST_MODIFIED_DATE AS VARCHAR) AS LAST_MODIFIED_DATE
FROM info i LEFT JOIN programs a ON i.VID = a.VID JOIN orders o ON o.o_custkey = i.VID"""
)


@check("view_hubspot_contacts", CONTACTS_VIEW)
def hubspot_contacts(spark, sf):
    tables = {
        "HUBSPOT_CONTACTS_INFO": domain.contact_info(spark, sf),
        "HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS": domain.programs(spark, sf),
        "HUBSPOT_CONTACTS": domain.staged_ids(spark, sf),
    }
    return views.hubspot_contacts(tables).select(*_CONTACT_COLUMNS)


_SURVEY_SELECT = """SELECT VID, LAST_NAME, FIRST_NAME, ACADEMIC_PROGRAM, LIFECYCLE_STAGE,
  CAST(LIFECYCLE_STAGE_DATE AS VARCHAR) AS LIFECYCLE_STAGE_DATE, CONVERSION_NAME, NUM_PAGE_VIEWS, PHONE,
  UPPER(c.EMAIL) AS EMAIL, UPPER(c.CU_EMAIL) AS CU_EMAIL, LEAD_STATUS, CAST(NULL AS VARCHAR) AS RESIDENCY,
  CAST(NULL AS VARCHAR) AS CU_ADMIT, CAST(LAST_MODIFIED_DATE AS VARCHAR) AS LAST_MODIFIED_DATE,
  CAST(NULL AS VARCHAR) AS KLOUTSCORE, SEGMENT, CAST(RESPONSE_DATE AS VARCHAR) AS RESPONSE_DATE, ANSWER
FROM contacts c LEFT JOIN responses r ON UPPER(c.{email}) = UPPER(r.EMAIL)"""
SURVEY_VIEW = (
    with_("contacts", "responses")
    + f"SELECT DISTINCT * FROM ({_SURVEY_SELECT.format(email='CU_EMAIL')} UNION ALL {_SURVEY_SELECT.format(email='EMAIL')})"
)


@check("view_contacts_with_survey", SURVEY_VIEW)
def contacts_with_survey(spark, sf):
    return views.contacts_with_survey(
        {"HUBSPOT_CONTACTS": domain.contacts(spark, sf), "ASK_NICELY_RESPONSES": domain.responses(spark, sf)}
    )


COURSE_VIEW = (
    with_("courses")
    + """SELECT CAMPUS_CD, ACADEMIC_YEAR, TERM_CD, TERM_SD, INSTRCTN_MODE_CD, COUNT(1) AS COURSE_COUNT,
  CAST(SUM(ENRL_TOT) AS BIGINT) AS ENROLLMENTS,
  CAST(SUM(ENRL_TOT) * SUM(UNITS_MAXIMUM) AS DOUBLE) AS CREDIT_HOURS,
  CAST(SUM(ENRL_TOT * UNITS_MAXIMUM) AS DOUBLE) AS CREDIT_HOURS_WEIGHTED
FROM courses GROUP BY CAMPUS_CD, ACADEMIC_YEAR, TERM_CD, TERM_SD, INSTRCTN_MODE_CD"""
)


def typed_courses(spark, sf):
    return COURSE_LISTS_PRD.conform(domain.courses_text(spark, sf))


@check("view_course_rollup", COURSE_VIEW)
def course_rollup(spark, sf):
    return views.course_rollup({"COGNOS_COURSE_LISTS_PRD": typed_courses(spark, sf)})
