"""Ad performance report (CSV): one row per ad and day, last 30 days, insert-only."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked
from spendloom.contracts.tables import STG_GOOGLE_ADWORDS
from spendloom.functions.numbers import micros, percent
from spendloom.operators.filters import trailing_window
from spendloom.operators.merge import rows_to_insert
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import select_renamed
from spendloom.sources.tabular import read_csv_report
from spendloom.store import Table

WINDOW_DAYS = 30
KEYS = ["AD_ID", "AD_DATE"]

# Report header and staging column, in report order.
HEADERS = {
    "Day": "AD_DATE",
    "Campaign ID": "CAMPAIGN_ID",
    "Campaign": "CAMPAIGN_NAME",
    "Ad group ID": "ADGROUP_ID",
    "Ad group": "ADGROUP_NAME",
    "Ad group state": "ADGROUP_STATUS",
    "Ad type": "AD_TYPE",
    "Description": "DESCRIPTION",
    "Headline 1": "HEADLINE",
    "Ad ID": "AD_ID",
    "Ad state": "AD_STATUS",
    "Clicks": "CLICKS",
    "Conv. rate": "CONVERSION_RATE",
    "Conversions": "CONVERSIONS",
    "Cost": "COST",
    "Cost / conv.": "COST_PER_CONVERSION",
    "CTR": "CLICK_THROUGH_RATE",
    "Engagement rate": "ENGAGEMENT_RATE",
    "Engagements": "ENGAGEMENTS",
    "Impressions": "IMPRESSIONS",
    "Interactions": "INTERACTIONS",
    "% new sessions": "PERCENT_INTERACTIONS_NEW",
    "Views": "VIDEO_VIEWS",
}
PERCENTS = ("CLICK_THROUGH_RATE", "ENGAGEMENT_RATE", "PERCENT_INTERACTIONS_NEW", "CONVERSION_RATE")
MICROS = ("COST", "COST_PER_CONVERSION")


def extract(report: DataFrame, as_of, days: int = WINDOW_DAYS) -> Checked:
    """Staging rows of the trailing window, and rejects (percent text without a number among them)."""
    named = select_renamed(report, HEADERS)
    # A value that does not convert keeps its text, so that the contract rejects the row.
    cleaned = named.withColumns(
        {c: F.coalesce(percent(F.col(c)).cast("string"), F.col(c)) for c in PERCENTS}
        | {c: F.coalesce(micros(F.col(c)).cast("string"), F.col(c)) for c in MICROS}
    )
    return STG_GOOGLE_ADWORDS.enforce(cleaned, required=("AD_DATE",)).map_good(lambda good: trailing_window(good, "AD_DATE", as_of, days))


@logged("adwords")
def run(spark: SparkSession, landing: str, staging: Table, production: Table, rejects: Table, as_of) -> DataFrame:
    staging.stage(extract(read_csv_report(spark, landing, tuple(HEADERS), unreadable=unreadable_to(rejects)), as_of), rejects)
    production.append(rows_to_insert(production.read(), staging.read(), KEYS, "AD_DATE"))
    return production.read()
