"""Blogs, blog posts, keywords and workflows: full reloads of one list each."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Contract, text, whole
from spendloom.plans.loads.fields import Item, Options, at, contract_of, local_time, project
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.sources.pages import read_pages
from spendloom.store import Table

BLOG = (
    "absolute_url string, analytics_page_id string, category_id bigint, created_date_time bigint, html_title string, "
    "id bigint, portal_id bigint"
)
# Source field behind each stored column.
BLOG_ITEMS: tuple[Item, ...] = (
    at(text("ABSOLUTE_URL"), "absolute_url"),
    at(text("ANALYTICS_PAGE_ID"), "analytics_page_id"),
    at(whole("CATEGORY_ID"), "category_id"),
    local_time("CREATED_AT", "created_date_time"),
    at(text("HTML_TITLE"), "html_title"),
    at(whole("ID"), "id"),
    at(whole("PORTAL_ID"), "portal_id"),
)
HS_BLOGS = contract_of("HS_BLOGS", BLOG_ITEMS)

BLOG_POST = (
    "analytics_page_id string, absolute_url string, analytics_page_type string, author string, author_at bigint, "
    "category string, category_id bigint, comment_count bigint, current_state string, currently_published boolean, "
    "html_title string, id bigint, label string, live_domain string, name string"
)
# Source field behind each stored column.
BLOG_POST_ITEMS: tuple[Item, ...] = (
    at(text("ANALYTICS_PAGE_ID"), "analytics_page_id"),
    at(text("ABSOLUTE_URL"), "absolute_url"),
    at(text("ANALYTICS_PAGE_TYPE"), "analytics_page_type"),
    at(text("AUTHOR"), "author"),
    local_time("AUTHOR_AT", "author_at"),
    at(text("CATEGORY"), "category"),
    at(whole("CATEGORY_ID"), "category_id"),
    at(whole("COMMENT_COUNT"), "comment_count"),
    at(text("CURRENT_STATE"), "current_state"),
    at(text("CURRENTLY_PUBLISHED"), "currently_published"),
    at(text("HTML_TITLE"), "html_title"),
    at(whole("ID"), "id"),
    at(text("LABEL"), "label"),
    at(text("LIVE_DOMAIN"), "live_domain"),
    at(text("NAME"), "name"),
)
HS_BLOG_POSTS = contract_of("HS_BLOG_POSTS", BLOG_POST_ITEMS)

KEYWORD = "keyword string, country string, visits bigint, contacts bigint, leads bigint, created_at bigint"
# Source field behind each stored column.
KEYWORD_ITEMS: tuple[Item, ...] = (
    at(text("KEYWORD"), "keyword"),
    at(text("COUNTRY"), "country"),
    at(whole("VISITS"), "visits"),
    at(whole("CONTACTS"), "contacts"),
    at(whole("LEADS"), "leads"),
    local_time("CREATED_AT", "created_at"),
)
HS_KEYWORDS = contract_of("HS_KEYWORDS", KEYWORD_ITEMS)

WORKFLOW = (
    "name string, id bigint, type string, enabled boolean, insertedAt bigint, updatedAt bigint, "
    "contactListIds struct<enrolled bigint, active bigint>, contactCounts struct<active bigint, enrolled bigint>"
)
# Source field behind each stored column.
WORKFLOW_ITEMS: tuple[Item, ...] = (
    at(text("NAME"), "name"),
    at(whole("ID"), "id"),
    at(text("TYPE"), "type"),
    at(text("ENABLED"), "enabled"),
    local_time("INSERTED_AT", "insertedAt"),
    local_time("UPDATED_AT", "updatedAt"),
    at(whole("LIST_ENROLLED"), "contactListIds", "enrolled"),
    at(whole("LIST_ACTIVE"), "contactListIds", "active"),
    at(whole("COUNT_ACTIVE"), "contactCounts", "active"),
    at(whole("COUNT_ENROLLED"), "contactCounts", "enrolled"),
)
# The two step columns have never held a value: their path does not exist.
STEP_COLUMNS = (text("FIRST_STEPS"), text("SECOND_STEPS"))
HS_WORKFLOWS = contract_of("HS_WORKFLOWS", WORKFLOW_ITEMS, *STEP_COLUMNS)


def blogs(records: DataFrame, options: Options = Options()) -> DataFrame:
    return HS_BLOGS.conform(records.select(*project(records, BLOG_ITEMS, options)))


def blog_posts(records: DataFrame, options: Options = Options()) -> DataFrame:
    return HS_BLOG_POSTS.conform(records.select(*project(records, BLOG_POST_ITEMS, options)))


def keywords(records: DataFrame, options: Options = Options()) -> DataFrame:
    return HS_KEYWORDS.conform(records.select(*project(records, KEYWORD_ITEMS, options)))


def workflows(records: DataFrame, options: Options = Options()) -> DataFrame:
    blank = [F.lit(None).cast("string").alias(f.name) for f in STEP_COLUMNS]
    return HS_WORKFLOWS.conform(records.select(*project(records, WORKFLOW_ITEMS, options), *blank))


@dataclass(frozen=True)
class Listing:
    """Where a list's records are in its pages, and what is stored of them."""

    record_path: str
    record: str
    contract: Contract
    rows: Callable[[DataFrame, Options], DataFrame]


BLOGS = Listing("objects", BLOG, HS_BLOGS, blogs)
BLOG_POSTS = Listing("objects", BLOG_POST, HS_BLOG_POSTS, blog_posts)
KEYWORDS = Listing("keywords", KEYWORD, HS_KEYWORDS, keywords)
WORKFLOWS = Listing("workflows", WORKFLOW, HS_WORKFLOWS, workflows)


@logged("content")
def run(
    spark: SparkSession,
    landing: str,
    listing: Listing,
    stored: Table,
    options: Options = Options(),
    rejects: Table | None = None,
    **read,
) -> DataFrame:
    """Full reload of one list from all its landed pages."""
    read["unreadable"] = unreadable_to(rejects)
    records = read_pages(spark, landing, listing.record_path, listing.record, **read)
    stored.replace(listing.rows(records, options))
    return stored.read()
