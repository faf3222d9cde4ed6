"""Merges of a staged batch into a stored table.

Stored rows are the older part of a table with metrics that differ from the
batch, so that a kept and a refreshed row can be told apart.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.checks import domain
from spendloom.checks.domain import with_
from spendloom.checks.registry import ORACLE, check, table
from spendloom.contracts.tables import HUBSPOT_CONTACTS
from spendloom.operators import merge
from spendloom.operators.filters import trailing_window
from spendloom.plans.loads import facebook, linkedin, social_posts
from spendloom.store import written

CUTOFF = domain.CUTOFF


def _before(df, day: str):
    return df.filter(F.col(day) < F.lit(CUTOFF).cast("date"))


# --- insert-only ---------------------------------------------------------------------

_INSERT = """SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CLICKS, CAST(SPEND AS DOUBLE) AS SPEND FROM (
    SELECT AD_ID, AD_DATE, CLICKS + 1000 AS CLICKS, SPEND FROM stg WHERE AD_DATE < DATE '{cutoff}'
    UNION ALL SELECT AD_ID, AD_DATE, CLICKS, SPEND FROM stg s WHERE {recent} NOT EXISTS (
      SELECT 1 FROM stg p WHERE p.AD_DATE < DATE '{cutoff}' AND p.AD_ID = s.AD_ID AND p.AD_DATE = s.AD_DATE))"""


def _stored_facebook(spark, sf):
    old = _before(domain.facebook_ads(spark, sf), "AD_DATE")
    return old.withColumn("CLICKS", (F.col("CLICKS") + 1000).cast("decimal(18,0)"))


@check(
    "merge_insert_only",
    with_(stg=domain.SQL["facebook_ads"]) + _INSERT.format(cutoff=CUTOFF, recent=""),
)
def insert_only(spark, sf):
    merged = merge.merge_insert(
        _stored_facebook(spark, sf), domain.facebook_ads(spark, sf), facebook.KEYS, prune_by="AD_DATE"
    )
    return merged.select("AD_ID", "AD_DATE", "CLICKS", "SPEND")


@check(
    "merge_insert_only_duplicates",
    f"""WITH stg AS ({domain.SQL["google_adwords"]}),
    prd AS (SELECT AD_ID, AD_DATE FROM stg WHERE AD_DATE < DATE '{CUTOFF}')
    SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CLICKS, FALSE AS inserted FROM stg WHERE AD_DATE < DATE '{CUTOFF}'
    UNION ALL SELECT AD_ID, CAST(AD_DATE AS VARCHAR), CLICKS, TRUE FROM stg s
    WHERE NOT EXISTS (SELECT 1 FROM prd p WHERE p.AD_ID = s.AD_ID AND p.AD_DATE = s.AD_DATE)""",
)
def insert_only_duplicates(spark, sf):
    # An ad may have several rows a day: all rows of a new key go in.
    staged = domain.google_adwords(spark, sf).select("AD_ID", "AD_DATE", "CLICKS")
    stored = _before(staged, "AD_DATE")
    added = merge.rows_to_insert(stored, staged, ["AD_ID", "AD_DATE"], "AD_DATE")
    return stored.withColumn("inserted", F.lit(False)).unionByName(added.withColumn("inserted", F.lit(True)))


@check(
    "cdc_overlap_reload",
    with_(stg=domain.SQL["facebook_ads"])
    + _INSERT.format(
        cutoff=CUTOFF, recent="AD_DATE >= DATE '1999-01-15' - 30 AND AD_DATE < DATE '1999-01-15' AND"
    ),
)
def overlap_reload(spark, sf):
    # The window reaches back over loaded days; loading it twice changes nothing.
    window = trailing_window(domain.facebook_ads(spark, sf), "AD_DATE", "1999-01-15", facebook.WINDOW_DAYS)
    once = merge.merge_insert(_stored_facebook(spark, sf), window, facebook.KEYS, "AD_DATE")
    twice = merge.merge_insert(once, window, facebook.KEYS, "AD_DATE")
    return twice.select("AD_ID", "AD_DATE", "CLICKS", "SPEND")


# --- upsert ----------------------------------------------------------------------------

@check(
    "merge_update_insert",
    with_("posts")
    + """SELECT POST_ID, CASE WHEN POST_CHANNEL IN ('click', 'view') THEN 'kept' ELSE 'CU Online' END AS CAMPAIGN,
    POST_CHANNEL, CASE WHEN POST_CHANNEL IN ('click', 'view') THEN 'first title' ELSE POST_TITLE END AS POST_TITLE,
    CLICKS, LIKES, RETWEETS, REPLIES, ITERACTIONS FROM posts""",
)
def update_insert(spark, sf):
    staged = domain.posts(spark, sf).withColumnRenamed("CAMPAIGN", "CAMPAIGN_ID")
    stored = (
        domain.posts(spark, sf)
        .filter(F.col("POST_CHANNEL").isin("click", "view"))
        .withColumns(
            {"CAMPAIGN": F.lit("kept"), "POST_TITLE": F.lit("first title"), "CLICKS": F.lit(0).cast("decimal(18,0)")}
        )
    )
    merged = social_posts.merged(stored, staged)
    return merged.select("POST_ID", "CAMPAIGN", "POST_CHANNEL", "POST_TITLE", *social_posts.COUNTERS)


@check("merge_update_insert_shuffled", ORACLE["merge_update_insert"])
def update_insert_shuffled(spark, sf):
    """The same merge by shuffled joins, as for a batch too large to broadcast."""
    keys = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        for k in keys:
            spark.conf.set(k, "-1")
        return written(update_insert(spark, sf), "upsert")
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- deletes and replacement ---------------------------------------------------------------


def _stored_contacts(spark, sf):
    """Every customer with each of its programs, loaded earlier."""
    info = domain.contact_info(spark, sf).withColumn("IMPORT_DATE", F.lit("2018-01-01").cast("date"))
    return HUBSPOT_CONTACTS.conform(info.join(domain.programs(spark, sf), "VID"))


def _batch_contacts(spark, sf):
    """Customers with an urgent order, once, with one program."""
    urgent = table(spark, sf, "orders").filter(F.col("o_orderpriority") == "1-URGENT")
    buyers = urgent.select(F.col("o_custkey").cast("decimal(18,0)").alias("VID")).distinct()
    info = domain.contact_info(spark, sf).withColumns(
        {"IMPORT_DATE": F.lit("2018-09-01").cast("date"), "ACADEMIC_PROGRAM": F.lit("NEW")}
    )
    return HUBSPOT_CONTACTS.conform(info.join(buyers, "VID", "left_semi"))


_OLD_CONTACTS = """SELECT i.VID, LAST_NAME, ACADEMIC_PROGRAM, '2018-01-01' AS IMPORT_DATE FROM info i
    JOIN programs p ON p.VID = i.VID WHERE i.VID NOT IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')"""


@check("merge_delete_matched", with_("info", "programs") + _OLD_CONTACTS)
def delete_matched(spark, sf):
    left = merge.delete_matched(_stored_contacts(spark, sf), _batch_contacts(spark, sf), ["VID"])
    return left.select("VID", "LAST_NAME", "ACADEMIC_PROGRAM", "IMPORT_DATE")


@check(
    "merge_replace_by_key",
    with_("info", "programs")
    + _OLD_CONTACTS
    + """ UNION ALL SELECT VID, LAST_NAME, 'NEW', '2018-09-01' FROM info
    WHERE VID IN (SELECT o_custkey FROM orders WHERE o_orderpriority = '1-URGENT')""",
)
def replace_by_key(spark, sf):
    merged = merge.replace_by_key(_stored_contacts(spark, sf), _batch_contacts(spark, sf), ["VID"])
    return merged.select("VID", "LAST_NAME", "ACADEMIC_PROGRAM", "IMPORT_DATE")


@check(
    "dml_delete_latest_day",
    """WITH prd AS (SELECT o_orderkey AS AD_ID,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS AD_DATE FROM orders)
    SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE FROM prd
    WHERE AD_DATE IS DISTINCT FROM (SELECT MAX(AD_DATE) FROM prd)""",
)
def delete_latest_day(spark, sf):
    # Partly open orders have no day; they stay.
    stored = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("AD_ID"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("AD_DATE"),
    )
    return merge.delete_latest_day(stored, "AD_DATE")


@check(
    "dml_highwater_prune",
    f"""WITH stg AS (SELECT o_orderkey AS VID,
      CASE WHEN o_orderstatus <> 'P' THEN CAST(o_orderdate AS DATE) END AS d FROM orders)
    SELECT VID, CAST(d AS VARCHAR) AS MODIFIED_DATE FROM stg WHERE d IS NULL OR d >=
    (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_shipdate < DATE '{CUTOFF}')""",
)
def highwater_prune(spark, sf):
    staged = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("VID"),
        F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate").cast("date")).alias("MODIFIED_DATE"),
    )
    stored = _before(domain.google_adwords(spark, sf), "AD_DATE")
    return merge.highwater_prune(staged, "MODIFIED_DATE", stored, "AD_DATE")


@check(
    "dml_delete_in_cascade",
    """SELECT 'parent' AS T, c_custkey AS VID, CAST(NULL AS BIGINT) AS CHILD FROM customer
    WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')
    UNION ALL SELECT 'child', o_custkey, o_orderkey FROM orders
    WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')""",
)
def delete_in_cascade(spark, sf):
    child = table(spark, sf, "orders").select(F.col("o_custkey").alias("VID"), F.col("o_orderkey").alias("CHILD"))
    parent = table(spark, sf, "customer").select(F.col("c_custkey").alias("VID"))
    gone = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P").select(F.col("o_custkey").alias("VID"))
    parents, children = merge.delete_cascade(parent, child, gone, "VID")
    top = parents.select(F.lit("parent").alias("T"), "VID", F.lit(None).cast("bigint").alias("CHILD"))
    return top.unionByName(children.select(F.lit("child").alias("T"), "VID", "CHILD"))


@check(
    "cdc_classify",
    f"""WITH src AS (SELECT c_custkey AS VID, TIMESTAMP '{CUTOFF}' AS changed FROM customer),
    known AS (SELECT DISTINCT o_custkey AS VID, o_orderdate AS at FROM orders WHERE o_orderstatus = 'P')
    SELECT s.VID, CASE WHEN k.at IS NULL THEN 'new' WHEN s.changed > k.at THEN 'modified' ELSE 'unchanged' END AS STATE
    FROM src s LEFT JOIN known k ON k.VID = s.VID""",
)
def classify(spark, sf):
    source = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("VID"), F.lit(CUTOFF).cast("timestamp_ntz").alias("CHANGED_AT")
    )
    stored = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.col("o_custkey").alias("VID"), F.col("o_orderdate").alias("UPDATED_AT"))
    )
    return merge.classify(source, stored, "VID", "CHANGED_AT", "UPDATED_AT").select("VID", "STATE")


@check(
    "merge_purge_then_insert",
    f"""WITH stg AS ({domain.SQL["linkedin_ads"]}),
    prd AS (SELECT CAMPAIGN_ID, AD_DATE, CREATIVE_ID, CLICKS + 1000 AS CLICKS FROM stg WHERE AD_DATE < DATE '{CUTOFF}'),
    kept AS (SELECT * FROM prd WHERE AD_DATE <> (SELECT MAX(AD_DATE) FROM prd))
    SELECT CAMPAIGN_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CREATIVE_ID, CLICKS FROM (
      SELECT * FROM kept UNION ALL SELECT CAMPAIGN_ID, AD_DATE, CREATIVE_ID, CLICKS FROM stg s
      WHERE NOT EXISTS (SELECT 1 FROM kept k WHERE k.CAMPAIGN_ID = s.CAMPAIGN_ID AND k.AD_DATE = s.AD_DATE))""",
)
def purge_then_insert(spark, sf):
    staged = domain.linkedin_ads(spark, sf)
    stored = _before(staged, "AD_DATE").withColumn("CLICKS", (F.col("CLICKS") + 1000).cast("decimal(18,0)"))
    return linkedin.merged(stored, staged).select("CAMPAIGN_ID", "AD_DATE", "CREATIVE_ID", "CLICKS")
