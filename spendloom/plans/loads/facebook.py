"""Ad insights: one row per ad and day, last 30 days, insert-only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked
from spendloom.contracts.tables import FACEBOOK_ADS, RETIRED_FACEBOOK_FIELDS, STG_FACEBOOK_ADS_0818
from spendloom.functions.text import leading
from spendloom.operators.filters import trailing_window
from spendloom.operators.merge import rows_to_insert
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import select_renamed
from spendloom.sources.pages import read_pages
from spendloom.store import Table

WINDOW_DAYS = 30
KEYS = ["AD_ID", "AD_DATE"]

# Source field and staging column.
FIELDS = {
    "account_id": "ACCOUNT_ID",
    "ad_id": "AD_ID",
    "adset_id": "ADSET_ID",
    "adset_name": "ADSET_NAME",
    "campaign_id": "CAMPAIGN_ID",
    "campaign_name": "CAMPAIGN_NAME",
    "clicks": "CLICKS",
    "cpc": "CPC",
    "cpm": "CPM",
    "cpp": "CPP",
    "ctr": "CTR",
    "date_start": "DATE_START",
    "date_stop": "DATE_END",
    "frequency": "FREQUENCY",
    "impressions": "IMPRESSIONS",
    "inline_link_click_ctr": "INLINE_LINK_CLICK_CTR",
    "inline_link_clicks": "INLINE_LINK_CLICKS",
    "objective": "OBJECTIVE",
    "reach": "REACH",
    "spend": "SPEND",
    "total_action_value": "TOTAL_ACTION_VALUE",
}
RECORD = ", ".join(f"{field} string" for field in FIELDS)


def extract(records: DataFrame, as_of, days: int = WINDOW_DAYS) -> Checked:
    """Staging rows of the trailing window, and rejects."""
    checked = STG_FACEBOOK_ADS_0818.enforce(select_renamed(records, FIELDS), required=("DATE_START",))
    return checked.map_good(lambda good: trailing_window(good, "DATE_START", as_of, days))


def to_production(staged: DataFrame) -> DataFrame:
    """Production layout; the program code opens the campaign name, retired fields are NULL."""
    row = staged.drop(*RETIRED_FACEBOOK_FIELDS).withColumns(
        {"PROGRAM_NAME": leading(F.col("CAMPAIGN_NAME"), 4), "AD_DATE": F.col("DATE_START")}
    )
    return FACEBOOK_ADS.conform(row)


@logged("facebook")
def run(
    spark: SparkSession, landing: str, staging: Table, production: Table, rejects: Table, as_of, **read
) -> DataFrame:
    staging.stage(extract(read_pages(spark, landing, "data", RECORD, unreadable=unreadable_to(rejects), **read), as_of), rejects)
    production.append(rows_to_insert(production.read(), to_production(staging.read()), KEYS, "AD_DATE"))
    return production.read()
