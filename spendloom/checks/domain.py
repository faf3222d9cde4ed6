"""The test tables in the shape of the marketing tables, in Spark and in SQL.

Every mapping reads a whole table and keeps all its rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.checks.registry import table
from spendloom.contracts.tables import (
    ASK_NICELY_RESPONSES,
    FACEBOOK_ADS,
    GOOGLE_ADWORDS,
    HUBSPOT_CONTACTS,
    HUBSPOT_SOCIAL_POSTS,
    LINKEDIN_ADS,
    STG_HUBSPOT_CONTACTS,
    STG_HUBSPOT_CONTACTS_INFO,
    STG_HUBSPOT_PROGRAMS,
    STG_LINKEDIN_ADS,
    STG_LINKEDIN_CAMPAIGNS_UPDATED,
    STG_LINKEDIN_LINK,
)
from spendloom.operators.reshape import explode_items

# A day inside the order and ship dates: stored rows are older, staged rows are all.
CUTOFF = "1999-01-01"


def _select(df: DataFrame, **columns: str) -> DataFrame:
    return df.selectExpr(*[f"{expr} AS {name}" for name, expr in columns.items()])


def _sql(source: str, **columns: str) -> str:
    listed = ", ".join(f"{expr} AS {name}" for name, expr in columns.items())
    return f"SELECT {listed} FROM {source}"


# Expressions that read the same in both engines.
ADWORDS_COLUMNS = dict(
    AD_DATE="CAST(l_shipdate AS DATE)",
    CAMPAIGN_ID="l_suppkey",
    CAMPAIGN_NAME="CASE l_returnflag WHEN 'A' THEN 'MC J' WHEN 'N' THEN 'Master Criminal Justice MCJ' ELSE l_returnflag END",
    ADGROUP_NAME="CONCAT('Group ', l_linestatus)",
    DESCRIPTION="l_returnflag",
    HEADLINE="CONCAT('Headline ', CAST(l_partkey AS VARCHAR(20)))",
    AD_ID="l_partkey",
    CLICKS="CAST(l_quantity AS BIGINT)",
    CONVERSIONS="CAST(l_linenumber AS BIGINT)",
    COST="CASE WHEN l_discount = 0 THEN 0 ELSE CAST(l_extendedprice AS DECIMAL(18,2)) END",
    IMPRESSIONS="CAST(l_quantity AS BIGINT) * (l_linenumber - 1)",
)
LINKEDIN_COLUMNS = dict(
    AD_DATE="CAST(o_orderdate AS DATE)",
    CAMPAIGN_ID="o_custkey",
    PROGRAM="CASE o_orderstatus WHEN 'O' THEN 'CUON' WHEN 'F' THEN 'MC J' ELSE 'BAPS' END",
    CAMPAIGN_NAME="CONCAT('Campaign ', CAST(o_custkey AS VARCHAR(20)))",
    CREATIVE_ID="o_orderkey",
    CLICKS="CAST(EXTRACT(DAY FROM o_orderdate) AS BIGINT) - 1",
    COST="CAST(o_totalprice AS DECIMAL(18,2))",
    IMPRESSIONS="CAST(EXTRACT(MONTH FROM o_orderdate) AS BIGINT) * 7",
)
FACEBOOK_COLUMNS = dict(
    PROGRAM_NAME="CASE o_orderpriority WHEN '1-URGENT' THEN 'CUON' WHEN '2-HIGH' THEN 'M CJ' ELSE LEFT(o_orderpriority, 4) END",
    AD_DATE="CAST(o_orderdate AS DATE)",
    CAMPAIGN_NAME="o_orderpriority",
    AD_ID="o_orderkey",
    ADSET_NAME="CONCAT('Set ', o_orderpriority)",
    CLICKS="CAST(EXTRACT(DAY FROM o_orderdate) AS BIGINT)",
    IMPRESSIONS="(CAST(EXTRACT(MONTH FROM o_orderdate) AS BIGINT) - 1) * 11",
    SPEND="CAST(o_totalprice AS DECIMAL(18,2))",
    TOTAL_ACTIONS="CAST(EXTRACT(MONTH FROM o_orderdate) AS BIGINT)",
)
POST_COLUMNS = dict(
    POST_ID="CONCAT('post-', CAST(event_id AS VARCHAR(20)))",
    CAMPAIGN="UPPER(event_type)",
    POST_CHANNEL="event_type",
    CREATED_DATE="CAST(ts AS DATE)",
    POST_TITLE="props",
    POST_URL="CONCAT('https://example.org/', CAST(event_id AS VARCHAR(20)))",
    CLICKS="CAST(FLOOR(value) AS BIGINT)",
    LIKES="user_id",
    RETWEETS="CAST(FLOOR(value / 2) AS BIGINT)",
    REPLIES="CAST(FLOOR(value / 4) AS BIGINT)",
    ITERACTIONS="CAST(FLOOR(value * 2) AS BIGINT)",
)
RESPONSE_COLUMNS = dict(
    RESPONSE_ID="o_orderkey",
    RESPONSE_DATE="CAST(o_orderdate AS DATE)",
    NAME="CONCAT('Customer ', CAST(o_custkey AS VARCHAR(20)))",
    SEGMENT="o_orderpriority",
    EMAIL="CONCAT('Customer#', LPAD(CAST(o_custkey AS VARCHAR(20)), 9, '0'))",
    ANSWER="CAST(EXTRACT(DAY FROM o_orderdate) AS BIGINT)",
)
# The school email is the address of the next customer; poorer accounts have none.
INFO_COLUMNS = dict(
    VID="c_custkey",
    FIRST_NAME="c_mktsegment",
    LAST_NAME="c_name",
    LIFECYCLE_STAGE="CASE WHEN c_acctbal < 0 THEN 'lead' ELSE 'customer' END",
    LIFECYCLE_STAGE_DATE="CAST('2018-01-01' AS DATE)",
    CONVERSION_NAME="c_mktsegment",
    NUM_PAGE_VIEWS="CAST(c_nationkey AS BIGINT)",
    PHONE="CONCAT('555-', CAST(c_custkey AS VARCHAR(20)))",
    EMAIL="LOWER(c_name)",
    CU_EMAIL="CASE WHEN c_acctbal >= 3000 THEN CONCAT('Customer#', LPAD(CAST(c_custkey + 1 AS VARCHAR(20)), 9, '0')) END",
    LEAD_STATUS="CASE WHEN c_acctbal < 0 THEN 'open' END",
    LAST_MODIFIED_DATE="CAST('2018-09-01' AS DATE)",
)
# Two programs for rich accounts, one for middling ones, none for the poorest.
PROGRAM_LIST = (
    "CASE WHEN c_acctbal >= 5000 THEN CONCAT(c_mktsegment, ';ONLINE') WHEN c_acctbal >= 1000 THEN c_mktsegment END"
)
COURSE_COLUMNS = dict(
    TERM_CD="CAST(EXTRACT(QUARTER FROM l_shipdate) AS VARCHAR(20))",
    TERM_SD="CONCAT('Q', CAST(EXTRACT(QUARTER FROM l_shipdate) AS VARCHAR(20)))",
    CLASS_NUM="CAST(l_orderkey AS VARCHAR(20))",
    CRSE_ID="CAST(l_partkey AS VARCHAR(20))",
    CAMPUS_CD="l_returnflag",
    ENRL_TOT="CAST(CAST(l_quantity AS BIGINT) AS VARCHAR(20))",
    UNITS_MAXIMUM="CONCAT(CAST(l_linenumber AS VARCHAR(20)), '.50')",
    INSTRCTN_MODE_CD="l_linestatus",
)

SQL = {
    "google_adwords": _sql("lineitem", **ADWORDS_COLUMNS),
    "linkedin_ads": _sql("orders", **LINKEDIN_COLUMNS),
    "facebook_ads": _sql("orders", **FACEBOOK_COLUMNS),
    "posts": _sql("events", **POST_COLUMNS),
    "responses": _sql("orders", **RESPONSE_COLUMNS),
    "info": _sql("customer", **INFO_COLUMNS),
    "contacts": _sql("customer", **{**INFO_COLUMNS, "ACADEMIC_PROGRAM": "c_mktsegment"}),
    "program_lists": _sql("customer", VID="c_custkey", PROGRAMS=PROGRAM_LIST),
    "programs": (
        "SELECT c_custkey AS VID, NULLIF(UNNEST(STRING_SPLIT(COALESCE("
        f"{PROGRAM_LIST}, ''), ';')), '') AS ACADEMIC_PROGRAM FROM customer"
    ),
    "courses": _sql(
        "lineitem",
        ACADEMIC_YEAR="CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT)",
        TERM_CD="CAST(EXTRACT(QUARTER FROM l_shipdate) AS BIGINT)",
        TERM_SD=COURSE_COLUMNS["TERM_SD"],
        CAMPUS_CD="l_returnflag",
        INSTRCTN_MODE_CD="l_linestatus",
        ENRL_TOT="CAST(l_quantity AS BIGINT)",
        UNITS_MAXIMUM="CAST(l_linenumber + 0.5 AS DECIMAL(18,2))",
    ),
}


def with_(*names: str, **extra: str) -> str:
    """WITH clause for the named tables, then ``extra`` ones that may use them."""
    parts = [f"{n} AS ({SQL[n]})" for n in names] + [f"{n} AS ({body})" for n, body in extra.items()]
    return "WITH " + ", ".join(parts) + " "


def google_adwords(spark: SparkSession, sf: str) -> DataFrame:
    return GOOGLE_ADWORDS.conform(_select(table(spark, sf, "lineitem"), **ADWORDS_COLUMNS))


def linkedin_ads(spark: SparkSession, sf: str) -> DataFrame:
    return LINKEDIN_ADS.conform(_select(table(spark, sf, "orders"), **LINKEDIN_COLUMNS))


def facebook_ads(spark: SparkSession, sf: str) -> DataFrame:
    return FACEBOOK_ADS.conform(_select(table(spark, sf, "orders"), **FACEBOOK_COLUMNS))


def posts(spark: SparkSession, sf: str) -> DataFrame:
    return HUBSPOT_SOCIAL_POSTS.conform(_select(table(spark, sf, "events"), **POST_COLUMNS))


def responses(spark: SparkSession, sf: str) -> DataFrame:
    return ASK_NICELY_RESPONSES.conform(_select(table(spark, sf, "orders"), **RESPONSE_COLUMNS))


def contact_info(spark: SparkSession, sf: str) -> DataFrame:
    return STG_HUBSPOT_CONTACTS_INFO.conform(_select(table(spark, sf, "customer"), **INFO_COLUMNS))


def contacts(spark: SparkSession, sf: str) -> DataFrame:
    columns = {**INFO_COLUMNS, "ACADEMIC_PROGRAM": "c_mktsegment"}
    return HUBSPOT_CONTACTS.conform(_select(table(spark, sf, "customer"), **columns))


def program_lists(spark: SparkSession, sf: str) -> DataFrame:
    return _select(table(spark, sf, "customer"), VID="c_custkey", PROGRAMS=PROGRAM_LIST)


def programs(spark: SparkSession, sf: str) -> DataFrame:
    return STG_HUBSPOT_PROGRAMS.conform(
        explode_items(program_lists(spark, sf), ["VID"], "PROGRAMS", "ACADEMIC_PROGRAM")
    )


def staged_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Customers with an order, once per order: staged ids may repeat."""
    return STG_HUBSPOT_CONTACTS.conform(
        _select(table(spark, sf, "orders"), VID="o_custkey", MODIFIED_DATE="CAST(o_orderdate AS DATE)")
    )


def courses_text(spark: SparkSession, sf: str) -> DataFrame:
    """Course list as delivered, with the year it belongs to."""
    columns = {**COURSE_COLUMNS, "ACADEMIC_YEAR": "CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT)"}
    return _select(table(spark, sf, "lineitem"), **columns)


def linkedin_staging(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Links from line items, campaigns from orders, one metrics row per part."""
    link = _select(
        table(spark, sf, "lineitem"), CAMPAIGN_ID="l_orderkey", CREATIVE_ID="l_partkey", STATUS="l_linestatus"
    )
    campaigns = _select(
        table(spark, sf, "orders"),
        ID="o_orderkey",
        CAMPAIGN_NAME="o_orderpriority",
        CREATED_DATE="CAST(o_orderdate AS DATE)",
        COST_TYPE="o_orderstatus",
        DAILY_BUDGET="CAST(o_totalprice AS DECIMAL(18,2))",
    )
    ads = _select(
        table(spark, sf, "part"),
        CREATIVE_ID="p_partkey",
        CLICKS="CAST(p_size AS BIGINT)",
        COST="CAST(p_retailprice AS DECIMAL(18,2))",
        IMPRESSIONS="CAST(p_size AS BIGINT) * 10",
        AD_DATE="CAST('2018-08-01' AS DATE)",
    )
    return {
        "LINKEDIN_CAMPAIGN_CREATIVE_LINK": STG_LINKEDIN_LINK.conform(link),
        "LINKEDIN_CAMPAIGNS_UPDATED": STG_LINKEDIN_CAMPAIGNS_UPDATED.conform(campaigns),
        "LINKEDIN_ADS": STG_LINKEDIN_ADS.conform(ads),
    }


def spend_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "GOOGLE_ADWORDS": google_adwords(spark, sf),
        "LINKEDIN_ADS": linkedin_ads(spark, sf),
        "FACEBOOK_ADS": facebook_ads(spark, sf),
        "HUBSPOT_SOCIAL_POSTS": posts(spark, sf),
    }


def millis(column: str):
    """Epoch milliseconds of a zone-free timestamp column."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_diff("MILLISECOND", epoch, F.col(column))
