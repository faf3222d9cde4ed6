"""Older contact tables: change detection against the stored copy, and form submissions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Contract, text, whole
from spendloom.functions.dates import epoch_ms_local_ts
from spendloom.functions.paths import path_value
from spendloom.operators.joins import matching_list, stale_keys, without_keys
from spendloom.operators.merge import classify
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import explode_children, explode_items
from spendloom.plans.loads.contacts import ID_RECORD, PROFILE, prop, version
from spendloom.plans.loads.fields import Item, Options, at, contract_of, key, local_time, project
from spendloom.sources.pages import read_documents, read_pages
from spendloom.store import Table, kept

# Profile property behind each stored column.
ITEMS: tuple[Item, ...] = (
    key(whole("VID"), "vid"),
    local_time("BIRTHDATE", *prop("birthdate")),
    local_time("CREATED_AT", *prop("createdate")),
    at(text("LIFECYCLE_STAGE"), *version("lifecyclestage", "value")),
    local_time("LIFECYCLE_STAGE_AT", *version("lifecyclestage", "timestamp")),
    at(text("FIRST_REFERRER"), *version("hs_analytics_first_referrer", "value")),
    local_time("FIRST_REFERRER_AT", *version("hs_analytics_first_referrer", "timestamp")),
    at(text("CONVERSION_NAME"), *version("recent_conversion_event_name", "value")),
    local_time("CONVERSION_AT", *version("recent_conversion_event_name", "timestamp")),
    at(text("NUM_PAGE_VIEWS"), *prop("hs_analytics_num_page_views")),
    at(text("CITY"), *prop("city")),
    at(text("STATE"), *prop("state")),
    at(text("ZIP"), *prop("zip")),
    local_time("SALES_EMAIL_LAST_OPENED", *prop("hs_sales_email_last_opened")),
    at(text("HUBSPOT_SCORE"), *prop("hubspotscore")),
    at(text("LAST_NAME"), *prop("lastname")),
    at(text("TWITTER"), *prop("twitterhandle")),
    at(text("LINKED_IN"), *prop("linkedinconnections")),
    at(text("PHONE"), *prop("phone")),
    at(text("SPECIALIZATIONS"), *prop("specializations")),
    at(text("BROADCAST_CLICKS"), *prop("hs_soclial_num_broadcast_clicks")),
    at(text("EMAIL"), *prop("email")),
    at(text("CU_EMAIL"), *prop("cu_email_address")),
    at(text("LEAD_STATUS"), *prop("hs_lead_status")),
    at(text("EMAILS_SINCE_LAST_ENGAGEMENT"), *prop("hs_emails_sends_since_last_engagement")),
    at(text("RESIDENCY"), *prop("residency")),
    at(text("EMAIL_OPTOUT"), *prop("hs_email_optout")),
    at(text("CU_ADMIT"), *prop("cu_admit")),
    at(text("FIRST_NAME"), *prop("firstname")),
    at(text("LINKED_IN_BIO"), *prop("linkedinbio")),
    local_time("CLOSED_AT", *prop("closeddate")),
    local_time("UPDATED_AT", *prop("lastmodifieddate")),
    at(text("KLOUTSCORE"), *prop("kloutscoregeneral")),
)
HS_CONTACTS = contract_of("HS_CONTACTS", ITEMS, text("LOADED_AT"), bucket_by=("VID",))
HS_CONTACT_PROGRAM = Contract(
    "HS_CONTACT_ACADEMIC_PROGRAM", (whole("VID"), text("ACADEMIC_PROGRAM")), bucket_by=("VID",)
)
HS_CONTACT_FORMS = Contract(
    "HS_CONTACT_FORMS",
    (whole("VID"), text("FORM"), text("FORM_DATE"), text("UPDATEDAT")),
    bucket_by=("VID",),
)


def listed(records: DataFrame, options: Options = Options()) -> DataFrame:
    """Contact ids of all landed pages with their local time of last change."""
    changed = path_value(records, prop("lastmodifieddate"))
    return records.select(
        F.col("vid").cast("decimal(18,0)").alias("VID"),
        epoch_ms_local_ts(changed, options.tz, options.mirror).alias("CHANGED_AT"),
    )


def changes(ids: DataFrame, stored: DataFrame) -> DataFrame:
    """Ids that are new or modified since they were stored."""
    return classify(ids, stored, "VID", "CHANGED_AT", "UPDATED_AT").filter(F.col("STATE") != "unchanged")


def contact_rows(profiles: DataFrame, loaded_at: str, options: Options = Options()) -> DataFrame:
    return HS_CONTACTS.conform(
        profiles.select(*project(profiles, ITEMS, options), F.lit(loaded_at).alias("LOADED_AT"))
    )


def program_rows(profiles: DataFrame) -> DataFrame:
    programs = path_value(profiles, prop("academic_program")).alias("_programs")
    split = explode_items(profiles.select(F.col("vid").alias("VID"), programs), ["VID"], "_programs", "ACADEMIC_PROGRAM")
    return HS_CONTACT_PROGRAM.conform(split)


@logged("legacy contacts")
def run(
    spark: SparkSession,
    landing: dict[str, str],
    contacts: Table,
    programs: Table,
    loaded_at: str,
    options: Options = Options(),
    rejects: Table | None = None,
    **read,
) -> tuple[DataFrame, DataFrame]:
    """Delete changed contacts with their programs, insert them from their profiles.

    Changes and profiles are written first: both tables are replaced from the same
    ones.  The child goes first, and all rows of a changed id give way to its
    profile's, new ids included.  What has changed is seen in the parent alone, so a
    load that stops between the two tables does the same again when it is run again.
    """
    read["unreadable"] = unreadable_to(rejects)
    records = read_pages(spark, landing["ids"], "contacts", ID_RECORD, **read)
    profiles = read_documents(spark, landing["profiles"], PROFILE, **read)
    with (
        kept(changes(listed(records, options), contacts.read()), "changes") as changed,
        kept(matching_list(profiles, F.col("vid"), changed, F.col("VID")), "profiles") as due,
    ):
        programs.merge_into(
            changed, lambda stored: without_keys(stored, changed, ["VID"]).unionByName(program_rows(due))
        )
        contacts.merge_into(
            changed,
            lambda stored: without_keys(stored, changed, ["VID"]).unionByName(contact_rows(due, loaded_at, options)),
        )
    return contacts.read(), programs.read()


def form_rows(profiles: DataFrame, loaded_at: str, options: Options = Options()) -> DataFrame:
    """One row per form submission."""
    vid = F.col("vid").alias("VID")
    children = explode_children(profiles, [vid], path_value(profiles, ("form-submissions",)), "_form")
    return HS_CONTACT_FORMS.conform(
        children.select(
            "VID",
            path_value(children, ("_form", "title")).alias("FORM"),
            epoch_ms_local_ts(path_value(children, ("_form", "timestamp")), options.tz).alias("FORM_DATE"),
            F.lit(loaded_at).alias("UPDATEDAT"),
        )
    )


def refreshed_forms(
    contacts: DataFrame,
    forms: DataFrame,
    profiles: DataFrame,
    loaded_at: str,
    stale=Column.__lt__,
    options: Options = Options(),
) -> DataFrame:
    """Form table with the submissions of stale or missing contacts reloaded."""
    due = stale_keys(contacts, forms, "VID", "UPDATED_AT", "UPDATEDAT", stale)
    return reloaded_forms(forms, due, profiles, loaded_at, options)


def reloaded_forms(
    forms: DataFrame, due: DataFrame, profiles: DataFrame, loaded_at: str, options: Options = Options()
) -> DataFrame:
    """Stored rows with those of the contacts that are due taken from their profiles."""
    fresh = form_rows(matching_list(profiles, F.col("vid"), due, F.col("VID")), loaded_at, options)
    return without_keys(forms, due, ["VID"]).unionByName(fresh)


@logged("contact forms")
def run_forms(
    spark: SparkSession,
    profiles: str,
    contacts: Table,
    forms: Table,
    loaded_at: str,
    options: Options = Options(),
    rejects: Table | None = None,
    **read,
) -> DataFrame:
    """Only the buckets of stale or missing contacts are read and written."""
    read["unreadable"] = unreadable_to(rejects)
    documents = read_documents(spark, profiles, PROFILE, **read)
    with kept(stale_keys(contacts.read(), forms.read(), "VID", "UPDATED_AT", "UPDATEDAT"), "due") as due:
        forms.merge_into(due, lambda stored: reloaded_forms(stored, due, documents, loaded_at, options))
    return forms.read()
