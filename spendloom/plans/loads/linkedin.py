"""Accounts, campaigns, creatives and daily analytics; newest day reloaded, then insert-only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked
from spendloom.contracts.tables import (
    LINKEDIN_ADS,
    STG_LINKEDIN_ADS,
    STG_LINKEDIN_CAMPAIGNS,
    STG_LINKEDIN_CAMPAIGNS_UPDATED,
    STG_LINKEDIN_LINK,
)
from spendloom.functions.dates import date_from_parts, epoch_ms_date, or_text
from spendloom.functions.numbers import fill_zero
from spendloom.functions.text import trailing, trailing_digits, urn
from spendloom.operators.filters import differs, trailing_window
from spendloom.operators.joins import left_join, matching_list
from spendloom.operators.merge import delete_latest_day, rows_to_insert
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import flatten, select_renamed
from spendloom.plans.views import linkedin_ads
from spendloom.sources.pages import read_pages
from spendloom.store import Table

WINDOW_DAYS = 150
# A creative that arrives later for a loaded campaign day is not inserted.
KEYS = ["CAMPAIGN_ID", "AD_DATE"]

# URN prefixes, states and types at the source.
ACCOUNT_URN = "urn:li:sponsoredAccount:"
CAMPAIGN_URN = "urn:li:sponsoredCampaign:"
CREATIVE_URN = "urn:li:sponsoredCreative:"
PERSONAL = "PERSONAL"
ACTIVE = "ACTIVE"

_AMOUNT = "struct<amount:string>"
_STAMPS = "struct<created:struct<time:bigint>,lastModified:struct<time:bigint>>"
ACCOUNT = "id bigint, name string, type string"
CAMPAIGN = (
    f"account string, id bigint, name string, objectiveType string, changeAuditStamps {_STAMPS}, costType string, "
    f"dailyBudget {_AMOUNT}, totalBudget {_AMOUNT}, type string, unitCost {_AMOUNT}, creativeSelection string, "
    "runSchedule struct<start:bigint,end:bigint>"
)
CREATIVE = f"id bigint, campaign string, status string, changeAuditStamps {_STAMPS}"
# Metrics are read as text, so that the contract judges each.
ANALYTICS = (
    "clicks string, comments string, companyPageClicks string, costInUsd string, impressions string, follows string, "
    "shares string, viralClicks string, viralFollows string, viralImpressions string, viralComments string, "
    "viralShares string, dateRange struct<start:struct<day:string,month:string,year:string>>"
)

# Flattened source field and staging column.
CAMPAIGN_FIELDS = {
    "account": "ACCOUNT",
    "id": "ID",
    "name": "CAMPAIGN_NAME",
    "objectiveType": "OBJECTIVE_TYPE",
    "changeAuditStamps.created.time": "CREATED_DATE",
    "changeAuditStamps.lastModified.time": "MODIFIED_DATE",
    "costType": "COST_TYPE",
    "dailyBudget.amount": "DAILY_BUDGET",
    "totalBudget.amount": "TOTAL_BUDGET_AMOUNT",
    "type": "CAMPAIGN_TYPE",
    "unitCost.amount": "UNIT_COST_AMOUNT",
    "creativeSelection": "CREATIVE_SELECTION",
    "runSchedule.start": "START_DATE",
    "runSchedule.end": "END_DATE",
}
CREATIVE_FIELDS = {
    "campaign": "CAMPAIGN_ID",
    "id": "CREATIVE_ID",
    "status": "STATUS",
    "changeAuditStamps.created.time": "CREATED_DATE",
    "changeAuditStamps.lastModified.time": "MODIFIED_DATE",
}
ANALYTICS_FIELDS = {
    "creative_id": "CREATIVE_ID",
    "clicks": "CLICKS",
    "comments": "AD_COMMENTS",
    "companyPageClicks": "COMPANY_PAGE_CLICKS",
    "costInUsd": "COST",
    "impressions": "IMPRESSIONS",
    "follows": "FOLLOWS",
    "shares": "SHARES",
    "viralClicks": "VIRAL_CLICKS",
    "viralFollows": "VIRAL_FOLLOWS",
    "viralImpressions": "VIRAL_IMPRESSIONS",
    "viralComments": "VIRAL_COMMENTS",
    "viralShares": "VIRAL_SHARES",
    "AD_DATE": "AD_DATE",
}


def business_accounts(accounts: DataFrame, excluded: Column | None = None) -> DataFrame:
    """Accounts that are not personal; a missing type counts as not personal."""
    kept = accounts.filter(differs(F.col("type"), PERSONAL))
    return kept if excluded is None else kept.filter(~excluded)


def _campaigns(campaigns: DataFrame, accounts: DataFrame) -> DataFrame:
    ours = matching_list(campaigns, F.col("account"), accounts, urn(ACCOUNT_URN, F.col("id")))
    named = select_renamed(flatten(ours), CAMPAIGN_FIELDS)
    days = ("CREATED_DATE", "MODIFIED_DATE", "START_DATE", "END_DATE")
    return named.withColumns({c: or_text(epoch_ms_date(F.col(c)), F.col(c)) for c in days})


def extract_campaigns(campaigns: DataFrame, accounts: DataFrame) -> Checked:
    """Staged campaigns of the given accounts, and rejects."""
    kept = _campaigns(campaigns, business_accounts(accounts))
    return STG_LINKEDIN_CAMPAIGNS_UPDATED.enforce(kept.select(*STG_LINKEDIN_CAMPAIGNS_UPDATED.names))


def extract_links(creatives: DataFrame, campaigns: DataFrame, nine_digits: bool = False) -> Checked:
    """Campaign-creative pairs of the staged campaigns, and rejects.

    The campaign id is the number that ends the URN; ``nine_digits`` takes its
    last nine characters instead.
    """
    ours = matching_list(creatives, F.col("campaign"), campaigns, urn(CAMPAIGN_URN, F.col("ID")))
    id_ = trailing(F.col("campaign"), 9) if nine_digits else trailing_digits(F.col("campaign"))
    named = select_renamed(flatten(ours.withColumn("campaign", id_)), CREATIVE_FIELDS)
    stamped = named.withColumns(
        {c: or_text(epoch_ms_date(F.col(c)), F.col(c)) for c in ("CREATED_DATE", "MODIFIED_DATE")}
    )
    return STG_LINKEDIN_LINK.enforce(stamped)


def extract_ads(
    analytics: DataFrame, links: DataFrame, as_of, days: int = WINDOW_DAYS, zero_missing: bool = False
) -> Checked:
    """Daily metrics of active creatives over the window, the running day included, and rejects.

    ``analytics`` carries the creative's URN as ``creative``, from the page.
    """
    active = links.filter(F.col("STATUS") == ACTIVE)
    ours = matching_list(analytics, F.col("creative"), active, urn(CREATIVE_URN, F.col("CREATIVE_ID")))
    parts = [F.col(f"`dateRange.start.{p}`") for p in ("year", "month", "day")]
    dated = flatten(ours).withColumns(
        {
            "creative_id": trailing_digits(F.col("creative")),
            "AD_DATE": or_text(date_from_parts(*parts), F.nullif(F.concat_ws("-", *parts), F.lit(""))),
        }
    )
    named = select_renamed(dated, ANALYTICS_FIELDS)
    if zero_missing:
        metrics = [c for c in named.columns if c not in ("CREATIVE_ID", "AD_DATE", "COST")]
        named = fill_zero(named, metrics).fillna("0", metrics)
    return STG_LINKEDIN_ADS.enforce(named, required=("AD_DATE",)).map_good(
        lambda good: trailing_window(good, "AD_DATE", as_of, days, include_today=True)
    )


def to_production(links: DataFrame, campaigns: DataFrame, ads: DataFrame) -> DataFrame:
    """Production layout; the schedule columns are no longer sent and stay NULL."""
    view = linkedin_ads(
        {"LINKEDIN_CAMPAIGN_CREATIVE_LINK": links, "LINKEDIN_CAMPAIGNS_UPDATED": campaigns, "LINKEDIN_ADS": ads}
    )
    return LINKEDIN_ADS.conform(view)


def merged(production: DataFrame, batch: DataFrame) -> DataFrame:
    """Production without its newest day, plus the batch rows of absent campaign days."""
    kept = delete_latest_day(production, "AD_DATE")
    return kept.unionByName(rows_to_insert(kept, batch, KEYS, "AD_DATE"))


def load(production: Table, batch: DataFrame) -> None:
    """The same merge in place: the newest day's partition is replaced, the other days only grow.

    The day goes first.  A load that stops between the two steps leaves that day
    the newest, and the next load replaces it again.
    """
    days = production.partitions()
    if not days:
        return production.append(batch)
    day, newest = F.col("AD_DATE"), F.lit(days[-1]).cast("date")
    production.replace_partition(batch.filter(day == newest), days[-1])
    others = batch.filter((day != newest) | day.isNull())
    production.append(rows_to_insert(production.read(), others, KEYS, "AD_DATE"))


@logged("linkedin")
def run(
    spark: SparkSession,
    landing: dict[str, str],
    staging: dict[str, Table],
    production: Table,
    rejects: Table,
    as_of,
    **read,
) -> DataFrame:
    """``landing`` is keyed by accounts, campaigns, creatives and ads, ``staging`` by the last three and batch.

    The joined batch is written before the merge, which reads it several times.
    """
    read["unreadable"] = unreadable_to(rejects)
    accounts = read_pages(spark, landing["accounts"], "elements", ACCOUNT, **read)
    campaigns = read_pages(spark, landing["campaigns"], "elements", CAMPAIGN, **read)
    creatives = read_pages(spark, landing["creatives"], "elements", CREATIVE, **read)
    analytics = read_pages(
        spark, landing["ads"], "elements", ANALYTICS, context={"creative": "string"}, **read
    )
    steps = (
        ("campaigns", lambda: extract_campaigns(campaigns, accounts)),
        ("creatives", lambda: extract_links(creatives, staging["campaigns"].read())),
        ("ads", lambda: extract_ads(analytics, staging["creatives"].read(), as_of)),
    )
    for name, extract in steps:
        staging[name].stage(extract(), rejects)
    staging["batch"].replace(to_production(*(staging[n].read() for n in ("creatives", "campaigns", "ads"))))
    load(production, staging["batch"].read())
    return production.read()


def scheduled_campaigns(
    campaigns: DataFrame, accounts: DataFrame, stored: DataFrame, excluded_account: int
) -> DataFrame:
    """Variant with schedule and total budget, beside the creation day already stored."""
    ours = business_accounts(accounts, F.col("id") == excluded_account)
    current = STG_LINKEDIN_CAMPAIGNS.conform(_campaigns(campaigns, ours))
    known = stored.select(
        "ID", F.col("ID").alias("STORED_ID"), F.col("CREATED_DATE").alias("STORED_CREATED_DATE")
    ).distinct()
    return left_join(current, known, ["ID"])
