"""Web analytics reports: positional rows to cleaned, typed columns; full reloads."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked, Contract, Field, day, rate, text, whole
from spendloom.functions.dates import report_date
from spendloom.functions.text import DIRECT, NO_MEDIUM, NOT_SET, blank_to_null, remove, substitute
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.sources.pages import read_documents
from spendloom.sources.tabular import POSITIONAL_PAGE, rows_to_columns
from spendloom.store import Table


def _unset(col: Column) -> Column:
    return remove(col, NOT_SET)


def _campaign(col: Column) -> Column:
    return remove(remove(col, "|"), NOT_SET)


def _as_is(col: Column) -> Column:
    return col


@dataclass(frozen=True)
class ReportColumn:
    """Position is the place in the report; every page uses the same list."""

    field: Field
    rule: Callable[[Column], Column] = _as_is


def _report(name: str, *columns: ReportColumn) -> tuple[Contract, tuple[ReportColumn, ...]]:
    return Contract(name, tuple(c.field for c in columns)), columns


# Report columns in order, with the sentinel each drops.
CAMPAIGNS = _report(
    "GA_CAMPAIGNS",
    ReportColumn(text("CAMPAIGN"), _campaign),
    ReportColumn(text("SOURCE"), lambda c: remove(c, DIRECT)),
    ReportColumn(text("AD_GROUP"), _unset),
    ReportColumn(day("REPORT_DATE"), report_date),
    ReportColumn(text("ADWORDS_CAMPAIGN_ID")),
    ReportColumn(whole("IMPRESSIONS")),
    ReportColumn(whole("AD_CLICKS")),
    ReportColumn(rate("AD_COST")),
    ReportColumn(rate("CPM")),
    ReportColumn(rate("CPC")),
    ReportColumn(rate("CTR")),
    ReportColumn(rate("COST_PER_TRANSACTION")),
    ReportColumn(rate("COST_PER_GOAL_CONVERSION")),
    ReportColumn(rate("COST_PER_CONVERSION")),
)
PAGES = _report(
    "GA_PAGE_TRACKING",
    ReportColumn(text("PAGE_PATH_LEVEL1"), _unset),
    ReportColumn(text("PAGE_PATH_LEVEL2"), _unset),
    ReportColumn(text("PAGE_PATH_LEVEL3"), _unset),
    ReportColumn(text("PAGE_PATH_LEVEL4"), _unset),
    ReportColumn(text("PAGE_TITLE"), _unset),
    ReportColumn(text("LANDING_PAGE_PATH"), _unset),
    ReportColumn(text("SECOND_PAGE_PATH"), _unset),
    ReportColumn(whole("PAGEVIEWS")),
    ReportColumn(whole("UNIQUE_PAGEVIEWS")),
    ReportColumn(rate("TIME_ON_PAGE")),
    ReportColumn(whole("EXITS")),
)
DEVICES = _report(
    "GA_PLATFORM_DEVICE",
    ReportColumn(text("OPERATING_SYSTEM"), _unset),
    ReportColumn(text("DEVICE_CATEGORY"), _unset),
    ReportColumn(text("MOBILE_DEVICE_BRANDING"), _unset),
    ReportColumn(whole("PAGEVIEWS"), _unset),
)
TRAFFIC = _report(
    "GA_TRAFFIC_SOURCES",
    ReportColumn(text("FULL_REFERRER"), _unset),
    ReportColumn(text("CAMPAIGN"), _unset),
    ReportColumn(text("ADWORDS_CAMPAIGN_ID"), _unset),
    ReportColumn(text("KEYWORD"), _unset),
    ReportColumn(text("SOCIAL_NETWORK"), _unset),
    ReportColumn(text("MEDIUM"), lambda c: remove(c, NO_MEDIUM)),
    ReportColumn(text("SOURCE"), lambda c: substitute(c, DIRECT, "direct")),
    ReportColumn(whole("ORGANIC_SEARCHES"), _unset),
)


def extract(pages: DataFrame, report: tuple[Contract, tuple[ReportColumn, ...]]) -> Checked:
    """Stored rows of a report, and rejects."""
    contract, columns = report
    named = rows_to_columns(pages, tuple(contract.names))
    cleaned = named.select(*[_cleaned(c).alias(c.field.name) for c in columns])
    return contract.enforce(cleaned)


@logged("web analytics")
def run(
    spark: SparkSession,
    landing: str,
    report: tuple[Contract, tuple[ReportColumn, ...]],
    stored: Table,
    rejects: Table,
    **read,
) -> DataFrame:
    """Full reload of one report from all its landed pages."""
    read["unreadable"] = unreadable_to(rejects)
    stored.stage(extract(read_documents(spark, landing, POSITIONAL_PAGE, **read), report), rejects)
    return stored.read()


def _cleaned(column: ReportColumn) -> Column:
    value = column.rule(F.col(column.field.name))
    return value if column.rule is report_date else blank_to_null(value)
