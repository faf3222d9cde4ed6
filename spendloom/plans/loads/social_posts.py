"""Social posts: counters of known posts refreshed, new posts inserted."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.contracts import Checked
from spendloom.contracts.tables import HUBSPOT_SOCIAL_POSTS, STG_HUBSPOT_SOCIAL_POSTS
from spendloom.functions.dates import epoch_ms_date, or_text
from spendloom.functions.lookups import campaign_program, channel_name
from spendloom.functions.text import first_part
from spendloom.operators.merge import merge_upsert
from spendloom.operators.rejects import logged, unreadable_to
from spendloom.operators.reshape import flatten, select_renamed
from spendloom.sources.pages import read_array
from spendloom.store import Table

KEYS = ["POST_ID"]
COUNTERS = ["CLICKS", "LIKES", "RETWEETS", "REPLIES", "ITERACTIONS"]

# Flattened source field and staging column.
FIELDS = {
    "broadcastGuid": "POST_ID",
    "campaignGuid": "CAMPAIGN_ID",
    "channelKey": "POST_CHANNEL",
    "createdAt": "CREATED_DATE",
    "content.title": "POST_TITLE",
    "messageUrl": "POST_URL",
    "clicks": "CLICKS",
    "likes": "LIKES",
    "retweets": "RETWEETS",
    "replies": "REPLIES",
    "interactionsCount": "ITERACTIONS",
}
RECORD = (
    "broadcastGuid string, campaignGuid string, channelKey string, createdAt string, content struct<title:string>, "
    "messageUrl string, clicks string, likes string, retweets string, replies string, interactionsCount string"
)


def extract(records: DataFrame) -> Checked:
    """Staged posts and rejects; the channel is the part of its key before the colon."""
    named = select_renamed(flatten(records), FIELDS)
    cleaned = named.withColumns(
        {
            "CREATED_DATE": or_text(epoch_ms_date(F.col("CREATED_DATE")), F.col("CREATED_DATE")),
            "POST_CHANNEL": first_part(F.col("POST_CHANNEL"), ":"),
        }
    )
    return STG_HUBSPOT_SOCIAL_POSTS.enforce(cleaned)


def to_production(staged: DataFrame) -> DataFrame:
    """Inserted rows carry the program and the display name of the channel."""
    return HUBSPOT_SOCIAL_POSTS.conform(
        staged.withColumns(
            {"CAMPAIGN": campaign_program(F.col("CAMPAIGN_ID")), "POST_CHANNEL": channel_name(F.col("POST_CHANNEL"))}
        )
    )


def merged(production: DataFrame, staged: DataFrame) -> DataFrame:
    return merge_upsert(production, staged, KEYS, COUNTERS, to_production)


@logged("social posts")
def run(spark: SparkSession, landing: str, staging: Table, production: Table, rejects: Table, **read) -> DataFrame:
    staging.stage(extract(read_array(spark, landing, RECORD, unreadable=unreadable_to(rejects), **read)), rejects)
    batch = staging.read()
    production.merge_into(batch, lambda stored: merged(stored, batch))
    return production.read()
