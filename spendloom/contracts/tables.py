"""Stored tables.

Fixed values: table names, column names, their order, types and text lengths
are what existing reports and loads expect.
"""

from __future__ import annotations

from spendloom.contracts.contract import Contract, day, flag, moment, money, number, rate, text, whole

# --- paid ads ---------------------------------------------------------------

GOOGLE_ADWORDS = Contract(
    "GOOGLE_ADWORDS",
    (
        day("AD_DATE"),
        whole("CAMPAIGN_ID"),
        text("CAMPAIGN_NAME", 100),
        whole("ADGROUP_ID"),
        text("ADGROUP_NAME", 100),
        text("ADGROUP_STATUS", 50),
        text("AD_TYPE", 50),
        text("DESCRIPTION", 255),
        text("HEADLINE", 255),
        whole("AD_ID"),
        text("AD_STATUS", 50),
        whole("CLICKS"),
        rate("CONVERSION_RATE"),
        whole("CONVERSIONS"),
        money("COST"),
        rate("COST_PER_CONVERSION"),
        rate("CLICK_THROUGH_RATE"),
        rate("ENGAGEMENT_RATE"),
        whole("ENGAGEMENTS"),
        whole("IMPRESSIONS"),
        whole("INTERACTIONS"),
        rate("PERCENT_INTERACTIONS_NEW"),
        whole("VIDEO_VIEWS"),
    ),
    partition_by=("AD_DATE",),
)

# Staged rows have the same columns; only production is laid out by day.
STG_GOOGLE_ADWORDS = Contract("STG_GOOGLE_ADWORDS", GOOGLE_ADWORDS.fields)

FACEBOOK_ADS = Contract(
    "FACEBOOK_ADS",
    (
        text("PROGRAM_NAME", 4),
        day("AD_DATE"),
        whole("ACCOUNT_ID"),
        whole("CAMPAIGN_ID"),
        text("CAMPAIGN_NAME", 255),
        whole("AD_ID"),
        whole("ADSET_ID"),
        text("ADSET_NAME", 255),
        whole("CLICKS"),
        rate("CPC"),
        rate("CPM"),
        rate("CPP"),
        rate("CTR"),
        rate("FREQUENCY"),
        whole("IMPRESSIONS"),
        rate("INLINE_LINK_CLICK_CTR"),
        whole("INLINE_LINK_CLICKS"),
        text("OBJECTIVE", 100),
        whole("REACH"),
        whole("SOCIAL_CLICKS"),
        whole("SOCIAL_IMPRESSIONS"),
        whole("SOCIAL_REACH"),
        money("SOCIAL_SPEND"),
        money("SPEND"),
        whole("TOTAL_ACTION_VALUE"),
        whole("TOTAL_ACTIONS"),
        whole("UNIQUE_CLICKS"),
        rate("UNIQUE_CTR"),
        whole("UNIQUE_SOCIAL_CLICKS"),
    ),
    partition_by=("AD_DATE",),
)

STG_FACEBOOK_ADS = Contract(
    "STG_FACEBOOK_ADS",
    (
        whole("ACCOUNT_ID"),
        whole("AD_ID"),
        whole("ADSET_ID"),
        text("ADSET_NAME", 255),
        whole("CAMPAIGN_ID"),
        text("CAMPAIGN_NAME", 255),
        whole("CLICKS"),
        rate("CPC"),
        rate("CPM"),
        rate("CPP"),
        rate("CTR"),
        day("DATE_START"),
        day("DATE_END"),
        rate("FREQUENCY"),
        whole("IMPRESSIONS"),
        rate("INLINE_LINK_CLICK_CTR"),
        whole("INLINE_LINK_CLICKS"),
        text("OBJECTIVE", 100),
        whole("REACH"),
        whole("SOCIAL_CLICKS"),
        whole("SOCIAL_IMPRESSIONS"),
        whole("SOCIAL_REACH"),
        money("SOCIAL_SPEND"),
        money("SPEND"),
        whole("TOTAL_ACTION_VALUE"),
        whole("TOTAL_ACTIONS"),
        whole("UNIQUE_CLICKS"),
        rate("UNIQUE_CTR"),
        whole("UNIQUE_SOCIAL_CLICKS"),
    ),
)

# Fields the insights source stopped sending.
RETIRED_FACEBOOK_FIELDS = (
    "SOCIAL_CLICKS",
    "SOCIAL_IMPRESSIONS",
    "SOCIAL_REACH",
    "SOCIAL_SPEND",
    "TOTAL_ACTIONS",
    "UNIQUE_CLICKS",
    "UNIQUE_CTR",
    "UNIQUE_SOCIAL_CLICKS",
)

STG_FACEBOOK_ADS_0818 = Contract(
    "STG_FACEBOOK_ADS_0818",
    tuple(f for f in STG_FACEBOOK_ADS.fields if f.name not in RETIRED_FACEBOOK_FIELDS),
)

LINKEDIN_ADS = Contract(
    "LINKEDIN_ADS",
    (
        day("AD_DATE"),
        whole("CAMPAIGN_ID"),
        text("PROGRAM", 4),
        text("CAMPAIGN_NAME", 255),
        day("CREATED_DATE"),
        text("COST_TYPE", 10),
        money("DAILY_BUDGET"),
        text("OBJECTIVE_TYPE", 100),
        text("CAMPAIGN_TYPE", 100),
        money("UNIT_COST_AMOUNT"),
        day("START_DATE"),
        day("END_DATE"),
        whole("CREATIVE_ID"),
        whole("CLICKS"),
        whole("AD_COMMENTS"),
        whole("COMPANY_PAGE_CLICKS"),
        money("COST"),
        whole("IMPRESSIONS"),
        whole("FOLLOWS"),
        whole("SHARES"),
        whole("VIRAL_CLICKS"),
        whole("VIRAL_FOLLOWS"),
        whole("VIRAL_IMPRESSIONS"),
        whole("VIRAL_COMMENTS"),
        whole("VIRAL_SHARES"),
    ),
    partition_by=("AD_DATE",),
)

STG_LINKEDIN_CAMPAIGNS = Contract(
    "STG_LINKEDIN_CAMPAIGNS",
    (
        text("ACCOUNT", 100),
        whole("ID"),
        text("CAMPAIGN_NAME", 255),
        text("OBJECTIVE_TYPE", 100),
        day("CREATED_DATE"),
        day("MODIFIED_DATE"),
        text("COST_TYPE", 100),
        money("DAILY_BUDGET"),
        money("TOTAL_BUDGET_AMOUNT"),
        text("CAMPAIGN_TYPE", 100),
        money("UNIT_COST_AMOUNT"),
        text("CREATIVE_SELECTION", 100),
        day("START_DATE"),
        day("END_DATE"),
    ),
)

# Fields dropped from the campaign list.
RETIRED_LINKEDIN_FIELDS = ("TOTAL_BUDGET_AMOUNT", "START_DATE", "END_DATE")

STG_LINKEDIN_CAMPAIGNS_UPDATED = Contract(
    "STG_LINKEDIN_CAMPAIGNS_UPDATED",
    tuple(f for f in STG_LINKEDIN_CAMPAIGNS.fields if f.name not in RETIRED_LINKEDIN_FIELDS),
)

STG_LINKEDIN_ADS = Contract(
    "STG_LINKEDIN_ADS",
    (
        whole("CREATIVE_ID"),
        whole("CLICKS"),
        whole("AD_COMMENTS"),
        whole("COMPANY_PAGE_CLICKS"),
        money("COST"),
        whole("IMPRESSIONS"),
        whole("FOLLOWS"),
        whole("SHARES"),
        whole("VIRAL_CLICKS"),
        whole("VIRAL_FOLLOWS"),
        whole("VIRAL_IMPRESSIONS"),
        whole("VIRAL_COMMENTS"),
        whole("VIRAL_SHARES"),
        day("AD_DATE"),
    ),
)

# Rows of the campaign view as staged for one load; production is laid out by day.
STG_LINKEDIN_ADS_VIEW = Contract("STG_LINKEDIN_ADS_VIEW", LINKEDIN_ADS.fields)

STG_LINKEDIN_LINK = Contract(
    "STG_LINKEDIN_CAMPAIGN_CREATIVE_LINK",
    (
        whole("CAMPAIGN_ID"),
        whole("CREATIVE_ID"),
        text("STATUS", 100),
        day("CREATED_DATE"),
        day("MODIFIED_DATE"),
    ),
)

# --- surveys, posts, contacts -------------------------------------------------

ASK_NICELY_RESPONSES = Contract(
    "ASK_NICELY_RESPONSES",
    (
        whole("RESPONSE_ID"),
        day("RESPONSE_DATE"),
        text("NAME", 100),
        text("SEGMENT", 100),
        text("EMAIL", 100),
        whole("ANSWER"),
    ),
)

# The post id is a GUID at the source, so it is kept as text.
HUBSPOT_SOCIAL_POSTS = Contract(
    "HUBSPOT_SOCIAL_POSTS",
    (
        text("POST_ID"),
        text("CAMPAIGN", 100),
        text("POST_CHANNEL", 50),
        day("CREATED_DATE"),
        text("POST_TITLE", 255),
        text("POST_URL", 255),
        whole("CLICKS"),
        whole("LIKES"),
        whole("RETWEETS"),
        whole("REPLIES"),
        whole("ITERACTIONS"),
    ),
    bucket_by=("POST_ID",),
)

STG_HUBSPOT_SOCIAL_POSTS = Contract(
    "STG_HUBSPOT_SOCIAL_POSTS",
    tuple(text("CAMPAIGN_ID", 100) if f.name == "CAMPAIGN" else f for f in HUBSPOT_SOCIAL_POSTS.fields),
)

STG_HUBSPOT_CONTACTS = Contract(
    "STG_HUBSPOT_CONTACTS",
    (whole("VID"), text("FIRST_NAME", 255), text("LAST_NAME", 255), day("MODIFIED_DATE")),
)

STG_HUBSPOT_CONTACTS_TEST = Contract("STG_HUBSPOT_CONTACTS_TEST", STG_HUBSPOT_CONTACTS.fields)

HUBSPOT_CONTACTS = Contract(
    "HUBSPOT_CONTACTS",
    (
        whole("VID"),
        text("FIRST_NAME", 100),
        text("LAST_NAME", 100),
        text("ACADEMIC_PROGRAM", 100),
        day("CREATED_DATE"),
        text("LIFECYCLE_STAGE", 100),
        day("LIFECYCLE_STAGE_DATE"),
        text("CONVERSION_NAME", 255),
        day("CONVERSION_DATE"),
        whole("NUM_PAGE_VIEWS"),
        text("HOME_CITY", 100),
        text("HOME_STATE", 100),
        text("HOME_ZIP", 10),
        whole("HUBSPOT_SCORE"),
        text("TWITTER", 100),
        text("LINKED_IN", 100),
        text("LINKED_IN_BIO", 255),
        text("PHONE", 50),
        text("SPECIALIZATIONS", 255),
        text("EMAIL", 100),
        text("CU_EMAIL", 100),
        text("LEAD_STATUS", 100),
        text("EMAILS_SINCE_LAST_ENGAGEMENT", 100),
        text("RESIDENCY", 50),
        text("CU_ADMIT", 50),
        day("CLOSED_DATE"),
        day("LAST_MODIFIED_DATE"),
        text("KLOUTSCORE", 50),
        day("IMPORT_DATE"),
    ),
    bucket_by=("VID",),
)

STG_HUBSPOT_CONTACTS_INFO = Contract(
    "STG_HUBSPOT_CONTACTS_INFO",
    tuple(f for f in HUBSPOT_CONTACTS.fields if f.name != "ACADEMIC_PROGRAM"),
)

STG_HUBSPOT_CONTACTS_VIEW = Contract("STG_HUBSPOT_CONTACTS_VIEW", HUBSPOT_CONTACTS.fields)

STG_HUBSPOT_PROGRAMS = Contract(
    "STG_HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS",
    (whole("VID"), text("ACADEMIC_PROGRAM", 100)),
)

# --- courses and enrolment ----------------------------------------------------

_COURSE_TEXT = (
    "TERM_CD",
    "TERM_SD",
    "SBJCT_CD",
    "CATALOG_NBR",
    "CLASS_SECTION_CD",
    "CLASS_NUM",
    "CRSE_ID",
    "CRSE_LD",
    "CAMPUS_CD",
    "ACAD_ORG_CD",
    "ACAD_GRP_CD",
    "ACAD_CAR_CD",
    "ENRL_TOT",
    "UNITS_MAXIMUM",
    "INSTRCTN_MODE_CD",
)

COURSE_LISTS = Contract("COGNOS_COURSE_LISTS", tuple(text(c, 255) for c in _COURSE_TEXT))

_COURSE_NUMBERS = {"TERM_CD": whole("TERM_CD"), "ENRL_TOT": whole("ENRL_TOT"), "UNITS_MAXIMUM": money("UNITS_MAXIMUM")}

COURSE_LISTS_PRD = Contract(
    "COGNOS_COURSE_LISTS_PRD",
    (whole("ACADEMIC_YEAR"), *(_COURSE_NUMBERS.get(c, text(c, 255)) for c in _COURSE_TEXT)),
)

ONLINE_STATUS = Contract(
    "ONLINE_STATUS",
    (
        whole("PERSON_ID"),
        text("TERM_SD", 10),
        text("ACAD_CAR_CD", 10),
        text("LAST_NM", 255),
        text("FIRST_NM", 255),
        text("PRE_CU_EMAIL", 255),
        text("DEN_EMAIL", 255),
        text("ACAD_LVL_SD", 50),
        text("ACAD_PROG_CD", 50),
        text("ACAD_PROG_LD", 255),
        text("ACAD_PLAN_CD", 50),
        text("ACAD_PLAN_LD", 255),
        text("ACAD_SPLAN_CD", 50),
        number("CUR_GPA_PTS", 3),
        number("CUM_GPA_PTS", 3),
        whole("TAKEN_PRGRS_UNIT"),
        whole("PASSD_PRGRS_UNIT"),
        whole("TOT_PASSD_PRGRSS"),
        whole("ONLINE_COUNT_CURRENT_TERM"),
        whole("TRADITIONAL_COUNT_CURRENT_TERM"),
        text("CURRENT_TERM_STATUS", 255),
        whole("ONLINE_COUNT_OVER_CAREER"),
        whole("TRADITIONAL_COUNT_OVER_CAREER"),
        text("CAREER_STATUS", 255),
    ),
)

ONLINE_STATUS_1718 = Contract(
    "ONLINE_STATUS_1718",
    (text("PERSONID", 255), text("ONLINE_COURSE_COUNT", 255), text("TRAD_COURSE_COUNT", 255)),
)

GRADS1718 = Contract(
    "GRADS1718",
    tuple(
        text(c, 255)
        for c in (
            "TERM",
            "LASTNM",
            "MIDDLENM",
            "FIRSTNM",
            "PERSONID",
            "FERPAFLG",
            "CAREER",
            "ACAD_PROGRAM",
            "DEGREE",
        )
    ),
)

# --- rejects and failures -----------------------------------------------------

ERROR_TABLE = Contract(
    "ERROR_TABLE",
    (whole("ROW_NR"), text("ERROR_TEXT"), flag("TRUNCATED"), text("CSV_DATA")),
)

MARKETING_ETL_ERRORS = Contract(
    "MARKETING_ETL_ERRORS",
    (moment("ETL_DATE"), text("FILE_NAME"), text("ERROR_MSG")),
)

PRODUCTION = (
    GOOGLE_ADWORDS,
    FACEBOOK_ADS,
    LINKEDIN_ADS,
    ASK_NICELY_RESPONSES,
    HUBSPOT_SOCIAL_POSTS,
    HUBSPOT_CONTACTS,
)

STAGING = (
    STG_FACEBOOK_ADS,
    STG_FACEBOOK_ADS_0818,
    STG_LINKEDIN_CAMPAIGNS,
    STG_LINKEDIN_CAMPAIGNS_UPDATED,
    STG_GOOGLE_ADWORDS,
    STG_LINKEDIN_ADS,
    STG_LINKEDIN_LINK,
    ASK_NICELY_RESPONSES,
    STG_HUBSPOT_CONTACTS,
    STG_HUBSPOT_CONTACTS_TEST,
    STG_HUBSPOT_CONTACTS_INFO,
    STG_HUBSPOT_PROGRAMS,
    STG_HUBSPOT_SOCIAL_POSTS,
    MARKETING_ETL_ERRORS,
)

WAREHOUSE = (ERROR_TABLE, ONLINE_STATUS, ONLINE_STATUS_1718, GRADS1718, COURSE_LISTS, COURSE_LISTS_PRD)
