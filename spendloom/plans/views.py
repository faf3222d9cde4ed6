"""Reporting views.  Each takes its tables by name and returns one DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.contracts import Contract, day, number, text, whole
from spendloom.functions.lookups import program_name
from spendloom.functions.numbers import safe_ratio
from spendloom.functions.text import leading
from spendloom.operators.joins import salted_left_join, spread_key
from spendloom.operators.reshape import union_branches

Tables = dict[str, DataFrame]

# Column names and labels the spend reports read.
DAILY_SPEND = Contract(
    "MARKETING_DAILY_SPEND",
    (
        text("PAID_SOCIAL"),
        text("MARKETING_PLATFORM"),
        day("AD_DATE"),
        text("PROGRAM"),
        text("CAMPAIGN"),
        text("HEADLINE"),
        text("DESCRIPTION"),
        text("AD_ID"),
        whole("CLICKS"),
        whole("CONVERSIONS"),
        number("COST", 2),
        whole("IMPRESSIONS"),
        number("CLICKS_PER_IMPRESSIONS", 3),
        number("COST_PER_CLICK", 2),
    ),
)
PAID, SOCIAL = "Paid", "Social"
ADWORDS, LINKEDIN, FACEBOOK = "Google Adwords", "LinkedIn", "Facebook"


def _paid(ads: DataFrame, platform: str, program: str, campaign: str, cost: str, **columns: Column) -> DataFrame:
    cost_, clicks, shown = F.col(cost), F.col("CLICKS"), F.col("IMPRESSIONS")
    return ads.filter(shown > 0).select(
        F.lit(PAID).alias("PAID_SOCIAL"),
        F.lit(platform).alias("MARKETING_PLATFORM"),
        "AD_DATE",
        program_name(F.col(program), platform).alias("PROGRAM"),
        F.col(campaign).alias("CAMPAIGN"),
        clicks,
        cost_.alias("COST"),
        shown,
        safe_ratio(clicks, shown, 10, 3).alias("CLICKS_PER_IMPRESSIONS"),
        safe_ratio(cost_, clicks, 10, 2).alias("COST_PER_CLICK"),
        *[col.alias(name) for name, col in columns.items()],
    )


def daily_spend(tables: Tables) -> DataFrame:
    """Paid ads of three platforms and social posts as one fact.

    Narrow projections under a union: nothing is shuffled, and a filter on
    platform or day reaches the scans and drops the branches it rules out.
    Posts report interactions as impressions and have no cost or ratios.
    """
    adwords = _paid(
        tables["GOOGLE_ADWORDS"],
        ADWORDS,
        "CAMPAIGN_NAME",
        "ADGROUP_NAME",
        "COST",
        HEADLINE=F.col("HEADLINE"),
        DESCRIPTION=F.col("DESCRIPTION"),
        AD_ID=F.col("AD_ID"),
        CONVERSIONS=F.col("CONVERSIONS"),
    )
    linkedin = _paid(
        tables["LINKEDIN_ADS"],
        LINKEDIN,
        "PROGRAM",
        "CAMPAIGN_NAME",
        "COST",
        HEADLINE=F.col("CAMPAIGN_NAME"),
        AD_ID=F.col("CREATIVE_ID"),
    )
    facebook = _paid(
        tables["FACEBOOK_ADS"],
        FACEBOOK,
        "PROGRAM_NAME",
        "ADSET_NAME",
        "SPEND",
        HEADLINE=F.col("ADSET_NAME"),
        AD_ID=F.col("AD_ID"),
        CONVERSIONS=F.col("TOTAL_ACTIONS"),
    )
    posts = tables["HUBSPOT_SOCIAL_POSTS"].select(
        F.lit(SOCIAL).alias("PAID_SOCIAL"),
        F.col("POST_CHANNEL").alias("MARKETING_PLATFORM"),
        F.col("CREATED_DATE").alias("AD_DATE"),
        F.col("CAMPAIGN").alias("PROGRAM"),
        "CAMPAIGN",
        F.col("POST_TITLE").alias("HEADLINE"),
        F.col("POST_TITLE").alias("DESCRIPTION"),
        F.col("POST_ID").alias("AD_ID"),
        "CLICKS",
        F.col("ITERACTIONS").alias("IMPRESSIONS"),
    )
    return union_branches(DAILY_SPEND, [adwords, linkedin, facebook, posts])


def spend_by_program(tables: Tables) -> DataFrame:
    """Daily spend totalled per platform and program."""
    return (
        daily_spend(tables)
        .groupBy("MARKETING_PLATFORM", "PROGRAM")
        .agg(
            F.count(F.lit(1)).alias("AD_DAYS"),
            F.sum("CLICKS").alias("CLICKS"),
            F.sum("IMPRESSIONS").alias("IMPRESSIONS"),
            F.sum("COST").alias("COST"),
        )
    )


def linkedin_ads(tables: Tables) -> DataFrame:
    """Creative-day metrics with the attributes of the creative's campaign."""
    link = tables["LINKEDIN_CAMPAIGN_CREATIVE_LINK"].select(
        F.col("CAMPAIGN_ID").alias("_camp"), F.col("CREATIVE_ID").alias("_creative")
    )
    campaigns = tables["LINKEDIN_CAMPAIGNS_UPDATED"].select(
        F.col("ID").alias("CAMPAIGN_ID"),
        leading(F.col("CAMPAIGN_NAME"), 4).alias("PROGRAM"),
        "CAMPAIGN_NAME",
        "CREATED_DATE",
        "COST_TYPE",
        "DAILY_BUDGET",
        "OBJECTIVE_TYPE",
        "CAMPAIGN_TYPE",
        "UNIT_COST_AMOUNT",
    )
    ads = tables["LINKEDIN_ADS"]
    joined = link.join(campaigns, F.col("_camp") == F.col("CAMPAIGN_ID")).join(
        ads, F.col("_creative") == F.col("CREATIVE_ID")
    )
    metrics = [c for c in ads.columns if c not in ("CREATIVE_ID", "AD_DATE")]
    return joined.select("AD_DATE", *campaigns.columns, "CREATIVE_ID", *metrics)


def hubspot_contacts(tables: Tables) -> DataFrame:
    """Contact details, one row per program, for the contacts staged in this load.

    Staged ids are joined first, so only their contacts go on to the programs;
    staged duplicates multiply rows.  Each table is read once.  A contact has few
    programs, and of a plain left join Spark can split the contacts' side.
    """
    info = tables["HUBSPOT_CONTACTS_INFO"]
    staged = tables["HUBSPOT_CONTACTS"].select("VID")
    programs = tables["HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS"].select("VID", "ACADEMIC_PROGRAM")
    joined = info.join(staged, "VID").join(programs, "VID", "left")
    rest = [c for c in info.columns if c not in ("VID", "FIRST_NAME", "LAST_NAME")]
    return joined.select("VID", "FIRST_NAME", "LAST_NAME", "ACADEMIC_PROGRAM", *rest)


# Contact columns of the survey report, in order.
SURVEY_CONTACT_COLUMNS = (
    "VID",
    "LAST_NAME",
    "FIRST_NAME",
    "ACADEMIC_PROGRAM",
    "LIFECYCLE_STAGE",
    "LIFECYCLE_STAGE_DATE",
    "CONVERSION_NAME",
    "NUM_PAGE_VIEWS",
    "PHONE",
    "EMAIL",
    "CU_EMAIL",
    "LEAD_STATUS",
    "RESIDENCY",
    "CU_ADMIT",
    "LAST_MODIFIED_DATE",
    "KLOUTSCORE",
)
SURVEY_ANSWER_COLUMNS = ("SEGMENT", "RESPONSE_DATE", "ANSWER")


def contacts_with_survey(tables: Tables) -> DataFrame:
    """Contacts with survey answers found by school email and by personal email.

    A contact contributes one lookup per email, so contacts and answers are
    shuffled once and the answers are read once.  Answers are made distinct per
    email beforehand: the result is distinct, so repeated answers from one
    address need never reach the join.  Contacts without an email spread over
    all tasks, and so do answers of an address that has a large share of them.
    """
    contacts = tables["HUBSPOT_CONTACTS"].select(
        *[F.upper(c).alias(c) if c in ("EMAIL", "CU_EMAIL") else F.col(c) for c in SURVEY_CONTACT_COLUMNS]
    )
    lookups = contacts.select("*", F.explode(F.array_distinct(F.array("CU_EMAIL", "EMAIL"))).alias("_mail")).withColumn(
        "_key", spread_key(F.col("_mail"), *[F.col(c) for c in contacts.columns])
    )
    answers = (
        tables["ASK_NICELY_RESPONSES"]
        .filter(F.col("EMAIL").isNotNull())
        .select(F.concat(F.lit("+"), F.upper("EMAIL")).alias("_key"), *SURVEY_ANSWER_COLUMNS)
    )
    joined = salted_left_join(lookups, answers.distinct(), "_key", sample=answers.select("_key"))
    return joined.select(*SURVEY_CONTACT_COLUMNS, *SURVEY_ANSWER_COLUMNS).distinct()


# Grouping columns of the course report.
COURSE_KEYS = ("CAMPUS_CD", "ACADEMIC_YEAR", "TERM_CD", "TERM_SD", "INSTRCTN_MODE_CD")


def course_rollup(tables: Tables, ordered: bool = False) -> DataFrame:
    """Courses, enrolments and credit hours per campus, year, term and mode.

    CREDIT_HOURS is the product of two totals, as the report has always shown;
    CREDIT_HOURS_WEIGHTED adds up enrolment times units per course.
    """
    enrolled, units = F.col("ENRL_TOT"), F.col("UNITS_MAXIMUM")
    rolled = (
        tables["COGNOS_COURSE_LISTS_PRD"]
        .groupBy(*COURSE_KEYS)
        .agg(
            F.count(F.lit(1)).alias("COURSE_COUNT"),
            F.sum(enrolled).alias("ENROLLMENTS"),
            (F.sum(enrolled) * F.sum(units)).alias("CREDIT_HOURS"),
            F.sum(enrolled * units).alias("CREDIT_HOURS_WEIGHTED"),
        )
    )
    return rolled.orderBy(*COURSE_KEYS) if ordered else rolled


# View names that reports query, and the tables behind each.
VIEWS = {
    "MARKETING_DAILY_SPEND_VIEW": (
        daily_spend,
        ("GOOGLE_ADWORDS", "LINKEDIN_ADS", "FACEBOOK_ADS", "HUBSPOT_SOCIAL_POSTS"),
    ),
    "HUBSPOT_WITH_ASK_NICELY_VIEW": (contacts_with_survey, ("HUBSPOT_CONTACTS", "ASK_NICELY_RESPONSES")),
    "LINKEDIN_ADS_VIEW": (
        linkedin_ads,
        ("LINKEDIN_CAMPAIGN_CREATIVE_LINK", "LINKEDIN_CAMPAIGNS_UPDATED", "LINKEDIN_ADS"),
    ),
    "HUBSPOT_CONTACTS_VIEW": (
        hubspot_contacts,
        ("HUBSPOT_CONTACTS_INFO", "HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS", "HUBSPOT_CONTACTS"),
    ),
    "COURSE_ROLLUP_VIEW": (course_rollup, ("COGNOS_COURSE_LISTS_PRD",)),
}


def register(name: str, tables: Tables) -> DataFrame:
    """Make a view available to ``spark.sql`` under its name."""
    view, needed = VIEWS[name]
    df = view({table: tables[table] for table in needed})
    df.createOrReplaceTempView(name)
    return df
