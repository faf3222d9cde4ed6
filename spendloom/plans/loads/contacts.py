"""CRM contacts: modified ids, their profiles, and replacement of all rows of each contact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked, day, text, whole
from spendloom.contracts.tables import STG_HUBSPOT_CONTACTS, STG_HUBSPOT_CONTACTS_INFO, STG_HUBSPOT_PROGRAMS
from spendloom.functions.dates import epoch_ms_date, or_text
from spendloom.functions.paths import path_value
from spendloom.operators.joins import matching_list
from spendloom.operators.merge import highwater_prune, replace_by_key
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import explode_items
from spendloom.plans.loads.fields import Item, Options, at, key, local_day, project
from spendloom.plans.views import hubspot_contacts
from spendloom.sources.pages import read_documents, read_pages
from spendloom.store import Table, kept

KEYS = ["VID"]

ID_RECORD = "vid bigint, properties map<string, struct<value string>>"
PROFILE = (
    "vid bigint, "
    "properties map<string, struct<value string, versions array<struct<value string, timestamp bigint>>>>, "
    "`form-submissions` array<struct<title string, timestamp bigint>>"
)


def prop(name: str) -> tuple[str, ...]:
    return ("properties", name, "value")


def version(name: str, part: str) -> tuple[str | int, ...]:
    return ("properties", name, "versions", 0, part)


# Profile property behind each staging column.
INFO_ITEMS: tuple[Item, ...] = (
    key(whole("VID"), "vid"),
    at(text("FIRST_NAME"), *prop("firstname")),
    at(text("LAST_NAME"), *prop("lastname")),
    local_day(day("CREATED_DATE"), *prop("createdate")),
    at(text("LIFECYCLE_STAGE"), *version("lifecyclestage", "value")),
    local_day(day("LIFECYCLE_STAGE_DATE"), *version("lifecyclestage", "timestamp")),
    at(text("CONVERSION_NAME"), *version("recent_conversion_event_name", "value")),
    local_day(day("CONVERSION_DATE"), *version("recent_conversion_event_name", "timestamp")),
    at(whole("NUM_PAGE_VIEWS"), *prop("hs_analytics_num_page_views")),
    at(text("HOME_CITY"), *prop("city")),
    at(text("HOME_STATE"), *prop("state")),
    at(text("HOME_ZIP"), *prop("zip")),
    at(whole("HUBSPOT_SCORE"), *prop("hubspotscore")),
    at(text("TWITTER"), *prop("twitterhandle")),
    at(text("LINKED_IN"), *prop("linkedinconnections")),
    at(text("LINKED_IN_BIO"), *prop("linkedinbio")),
    at(text("PHONE"), *prop("phone")),
    at(text("SPECIALIZATIONS"), *prop("specializations")),
    at(text("EMAIL"), *prop("email")),
    at(text("CU_EMAIL"), *prop("cu_email_address")),
    at(text("LEAD_STATUS"), *prop("hs_lead_status")),
    at(text("EMAILS_SINCE_LAST_ENGAGEMENT"), *prop("hs_emails_sends_since_last_engagement")),
    at(text("RESIDENCY"), *prop("residency")),
    at(text("CU_ADMIT"), *prop("cu_admit")),
    local_day(day("CLOSED_DATE"), *prop("closeddate")),
    local_day(day("LAST_MODIFIED_DATE"), *prop("lastmodifieddate")),
    at(text("KLOUTSCORE"), *prop("kloutscoregeneral")),
)


def extract_ids(records: DataFrame) -> Checked:
    """Contact ids with name and day of last change, and rejects."""
    changed = path_value(records, prop("lastmodifieddate"))
    named = records.select(
        F.col("vid").alias("VID"),
        path_value(records, prop("firstname")).alias("FIRST_NAME"),
        path_value(records, prop("lastname")).alias("LAST_NAME"),
        or_text(epoch_ms_date(changed), changed).alias("MODIFIED_DATE"),
    )
    return STG_HUBSPOT_CONTACTS.enforce(named)


def extract_info(profiles: DataFrame, as_of, options: Options = Options()) -> Checked:
    """Contact details stamped with the load day, and rejects."""
    row = profiles.select(*project(profiles, INFO_ITEMS, options), F.lit(str(as_of)).alias("IMPORT_DATE"))
    return STG_HUBSPOT_CONTACTS_INFO.enforce(row)


def extract_programs(profiles: DataFrame) -> Checked:
    """One row per program of a contact, and rejects; a contact without any has one NULL row."""
    listed = profiles.select(
        F.col("vid").alias("VID"), path_value(profiles, prop("academic_program")).alias("_programs")
    )
    return STG_HUBSPOT_PROGRAMS.enforce(explode_items(listed, ["VID"], "_programs", "ACADEMIC_PROGRAM"))


@logged("contacts")
def run(
    spark: SparkSession,
    landing: dict[str, str],
    staging: dict[str, Table],
    production: Table,
    rejects: Table,
    as_of,
    options: Options = Options(),
    **read,
) -> DataFrame:
    """``landing`` holds ids and profiles; ``staging`` ids, info, programs and batch."""
    read["unreadable"] = unreadable_to(rejects)
    ids = extract_ids(read_pages(spark, landing["ids"], "contacts", ID_RECORD, **read))
    recent = ids.map_good(lambda good: highwater_prune(good, "MODIFIED_DATE", production, "LAST_MODIFIED_DATE"))
    staging["ids"].stage(recent, rejects)

    documents = read_documents(spark, landing["profiles"], PROFILE, **read)
    with kept(matching_list(documents, F.col("vid"), staging["ids"].read(), F.col("VID")), "profiles") as due:
        staging["info"].stage(extract_info(due, as_of, options), rejects)
        staging["programs"].stage(extract_programs(due), rejects)

    view = hubspot_contacts(
        {
            "HUBSPOT_CONTACTS_INFO": staging["info"].read(),
            "HUBSPOT_CONTACTS": staging["ids"].read(),
            "HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS": staging["programs"].read(),
        }
    )
    staging["batch"].replace(view)
    batch = staging["batch"].read()
    production.merge_into(batch, lambda stored: replace_by_key(stored, batch, KEYS))
    return production.read()


@logged("contacts, first load")
def run_initial(spark: SparkSession, landing: str, staging: Table, rejects: Table, **read) -> DataFrame:
    """Full load of the id list."""
    read["unreadable"] = unreadable_to(rejects)
    staging.stage(extract_ids(read_pages(spark, landing, "contacts", ID_RECORD, **read)), rejects)
    return staging.read()
