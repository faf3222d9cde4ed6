"""Engagements, workflow enrolments and email campaigns: full reloads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Contract, text, whole
from spendloom.functions.paths import path_value
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import explode_children
from spendloom.plans.loads.contacts import ID_RECORD
from spendloom.plans.loads.fields import Item, Options, at, clean, contract_of, key, local_time, project
from spendloom.sources.pages import read_documents, read_pages
from spendloom.store import Table

_PERSON = "struct<email string, firstName string, lastName string>"
ENGAGEMENT = (
    "engagement struct<id bigint, active boolean, createdAt bigint, lastUpdated bigint, type string, uid string, "
    "timestamp bigint, portalId bigint, createdBy bigint, modifiedBy bigint, ownerId bigint, teamId bigint>, "
    "associations struct<contactIds array<bigint>, companyIds array<bigint>, dealIds array<bigint>, "
    "ownerIds array<bigint>, workflowIds array<bigint>>, "
    f"metadata struct<`from` {_PERSON}, `to` array<{_PERSON}>, body string, status string, forObjectType string, "
    "subject string, reminders array<bigint>, text string, title string, source string, startTime bigint, "
    "endTime bigint, toNumber string, fromNumber string>"
)

# Document path behind each stored column.
ENGAGEMENT_ITEMS: tuple[Item, ...] = (
    clean("ENGAGEMENT_ID", "engagement", "id"),
    clean("ACTIVE", "engagement", "active"),
    local_time("CREATED_AT", "engagement", "createdAt"),
    local_time("LAST_UPDATED", "engagement", "lastUpdated"),
    clean("TYPE", "engagement", "type"),
    clean("UID", "engagement", "uid"),
    local_time("ENGAGED_AT", "engagement", "timestamp"),
    clean("CONTACT_ID", "associations", "contactIds", 0),
    clean("COMPANY_ID", "associations", "companyIds", 0),
    clean("DEAL_ID", "associations", "dealIds", 0),
    clean("ASSOCIATED_OWNER_ID", "associations", "ownerIds", 0),
    clean("WORKFLOW_ID", "associations", "workflowIds", 0),
    clean("FROM_EMAIL", "metadata", "from", "email"),
    clean("FROM_FIRST_NAME", "metadata", "from", "firstName"),
    clean("FROM_LAST_NAME", "metadata", "from", "lastName"),
    clean("TO_EMAIL", "metadata", "to", 0, "email"),
    clean("TO_FIRST_NAME", "metadata", "to", 0, "firstName"),
    clean("TO_LAST_NAME", "metadata", "to", 0, "lastName"),
    clean("BODY", "metadata", "body"),
    clean("STATUS", "metadata", "status"),
    clean("FOR_OBJECT_TYPE", "metadata", "forObjectType"),
    clean("SUBJECT", "metadata", "subject"),
    local_time("REMINDER", "metadata", "reminders", 0),
    clean("TEXT", "metadata", "text"),
    clean("TITLE", "metadata", "title"),
    clean("SOURCE", "metadata", "source"),
    local_time("START_TIME", "metadata", "startTime"),
    local_time("END_TIME", "metadata", "endTime"),
    clean("TO_NUMBER", "metadata", "toNumber"),
    clean("FROM_NUMBER", "metadata", "fromNumber"),
    clean("PORTAL_ID", "engagement", "portalId"),
    clean("CREATED_BY", "engagement", "createdBy"),
    clean("MODIFIED_BY", "engagement", "modifiedBy"),
    clean("OWNER_ID", "engagement", "ownerId"),
    clean("TEAM_ID", "engagement", "teamId"),
)
HS_CONTACT_ENGAGEMENTS = contract_of("HS_CONTACT_ENGAGEMENTS", ENGAGEMENT_ITEMS)


def engagements(records: DataFrame, options: Options = Options()) -> DataFrame:
    return HS_CONTACT_ENGAGEMENTS.conform(records.select(*project(records, ENGAGEMENT_ITEMS, options)))


# Arrays of which the stored row holds the first entry, and how an entry reads as text.
ENTRIES = {
    "CONTACT_ID": (("associations", "contactIds"), ()),
    "COMPANY_ID": (("associations", "companyIds"), ()),
    "DEAL_ID": (("associations", "dealIds"), ()),
    "ASSOCIATED_OWNER_ID": (("associations", "ownerIds"), ()),
    "WORKFLOW_ID": (("associations", "workflowIds"), ()),
    "TO_EMAIL": (("metadata", "to"), ("email",)),
    "REMINDER": (("metadata", "reminders"), ()),
}
HS_ENGAGEMENT_ENTRIES = Contract(
    "HS_ENGAGEMENT_ENTRIES", (text("ENGAGEMENT_ID"), text("ENTRY"), whole("POSITION"), text("VALUE"))
)


def engagement_entries(records: DataFrame) -> DataFrame:
    """Every entry of the arrays of an engagement, by name and position; the child table of the engagements."""
    id_ = path_value(records, ("engagement", "id"), True).cast("string")
    lists = []
    for name, (path, leaf) in ENTRIES.items():
        entries = F.col(".".join(f"`{p}`" for p in path))
        lists.append(
            F.transform(
                F.coalesce(entries, F.array().cast(dict(records.select(entries.alias("a")).dtypes)["a"])),
                _entry(name, leaf),
            )
        )
    every = records.select(id_.alias("ENGAGEMENT_ID"), F.explode(F.concat(*lists)).alias("_e"))
    return HS_ENGAGEMENT_ENTRIES.conform(every.select("ENGAGEMENT_ID", "_e.*"))


def _entry(name: str, leaf: tuple[str, ...]):
    def row(entry: Column, position: Column) -> Column:
        for part in leaf:
            entry = entry[part]
        return F.struct(F.lit(name).alias("ENTRY"), position.alias("POSITION"), entry.cast("string").alias("VALUE"))

    return row


# A contact's enrolments land as one document with the contact id beside them.
_TRIGGER = "struct<id bigint, type string, name string, enrollContactsOnActivation boolean>"
ENROLMENTS = (
    "vid bigint, workflows array<struct<id bigint, portalId bigint, insertedAt bigint, updatedAt bigint, name string, "
    f"triggerSet array<struct<trigger array<{_TRIGGER}>>>, "
    "steps struct<emailActions string, id string, branchCondition struct<filtersListId string>>>>"
)

# Document path behind each stored column.
WORKFLOW_ITEMS: tuple[Item, ...] = (
    key(whole("VID"), "vid"),
    at(whole("TRIGGER_ID"), "_set", "trigger", 0, "id"),
    at(text("TRIGGER_TYPE"), "_set", "trigger", 0, "type"),
    at(text("TRIGGER_NAME"), "_set", "trigger", 0, "name"),
    at(text("ENROLL_ON_ACTIVATION"), "_set", "trigger", 0, "enrollContactsOnActivation"),
    at(whole("WORKFLOW_ID"), "_flow", "id"),
    at(whole("PORTAL_ID"), "_flow", "portalId"),
    local_time("INSERTED_AT", "_flow", "insertedAt"),
    local_time("UPDATED_AT", "_flow", "updatedAt"),
    at(text("NAME"), "_flow", "name"),
    at(text("STEP_EMAIL_ACTIONS"), "_flow", "steps", "emailActions"),
    at(text("STEP_ID"), "_flow", "steps", "id"),
    at(text("STEP_FILTERS_LIST_ID"), "_flow", "steps", "branchCondition", "filtersListId"),
)
HS_CONTACT_WORKFLOW = contract_of("HS_CONTACT_WORKFLOW", WORKFLOW_ITEMS)


def contact_workflow(
    contacts: DataFrame, enrolments: DataFrame, options: Options = Options(), all_entries: bool = False
) -> DataFrame:
    """One row per trigger set of each listed contact's first workflow, or of all its workflows."""
    ids = contacts.select("vid")
    flow = F.explode("workflows") if all_entries else F.get("workflows", F.lit(0))
    listed = enrolments.select("vid", flow.alias("_flow")).join(ids, "vid")
    sets = explode_children(
        listed, [F.col("vid"), F.col("_flow")], path_value(listed, ("_flow", "triggerSet")), "_set"
    )
    return HS_CONTACT_WORKFLOW.conform(sets.select(*project(sets, WORKFLOW_ITEMS, options)))


CAMPAIGN_ID_RECORD = "id bigint, appId bigint"
# Counters of an email campaign.
COUNTERS = (
    "processed",
    "deferred",
    "unsubscribed",
    "statuschange",
    "bounce",
    "mta_dropped",
    "dropped",
    "sent",
    "click",
    "open",
    "spamreport",
)
CAMPAIGN_DETAIL = (
    "id bigint, appId bigint, subject string, name string, appName string, type string, "
    f"counters struct<{', '.join(f'{c} bigint' for c in COUNTERS)}>, "
    "processingState string, lastProcessingFinishedAt bigint"
)
CAMPAIGN_ITEMS: tuple[Item, ...] = (
    key(whole("ID"), "id"),
    key(whole("APP_ID"), "appId"),
    at(text("SUBJECT"), "subject"),
    at(text("NAME"), "name"),
    at(text("APP_NAME"), "appName"),
    at(text("TYPE"), "type"),
    *(at(whole(c.upper()), "counters", c) for c in COUNTERS),
    at(text("PROCESSING_STATE"), "processingState"),
    local_time("LAST_PROCESSING_FINISHED_AT", "lastProcessingFinishedAt"),
)
HS_CAMPAIGNS = contract_of("HS_CAMPAIGNS", CAMPAIGN_ITEMS)


def email_campaigns(ids: DataFrame, details: DataFrame, options: Options = Options()) -> DataFrame:
    """Details of each listed campaign."""
    listed = details.join(ids.select("id", "appId"), ["id", "appId"])
    return HS_CAMPAIGNS.conform(listed.select(*project(listed, CAMPAIGN_ITEMS, options)))


@logged("engagements")
def run_engagements(
    spark: SparkSession,
    landing: str,
    stored: Table,
    options: Options = Options(),
    rejects: Table | None = None,
    entries: Table | None = None,
    **read,
) -> DataFrame:
    """The stored row holds the first entry of each array; ``entries``, if given, takes all of them."""
    read["unreadable"] = unreadable_to(rejects)
    records = read_pages(spark, landing, "results", ENGAGEMENT, **read)
    stored.replace(engagements(records, options))
    if entries is not None:
        entries.replace(engagement_entries(records))
    return stored.read()


@logged("contact workflow")
def run_workflows(
    spark: SparkSession,
    landing: dict[str, str],
    stored: Table,
    options: Options = Options(),
    rejects: Table | None = None,
    all_entries: bool = False,
    **read,
) -> DataFrame:
    """``landing`` holds contact ids and their enrolments; ``all_entries`` takes workflows after the first too."""
    read["unreadable"] = unreadable_to(rejects)
    contacts = read_pages(spark, landing["ids"], "contacts", ID_RECORD, **read)
    found = read_documents(spark, landing["enrolments"], ENROLMENTS, **read)
    stored.replace(contact_workflow(contacts, found, options, all_entries))
    return stored.read()


@logged("email campaigns")
def run_campaigns(
    spark: SparkSession, landing: dict[str, str], stored: Table, options: Options = Options(), rejects: Table | None = None, **read
) -> DataFrame:
    """``landing`` holds campaign ids and details."""
    read["unreadable"] = unreadable_to(rejects)
    ids = read_pages(spark, landing["ids"], "campaigns", CAMPAIGN_ID_RECORD, **read)
    details = read_documents(spark, landing["details"], CAMPAIGN_DETAIL, **read)
    stored.replace(email_campaigns(ids, details, options))
    return stored.read()
