"""Projection, filters, joins, aggregates, unions and exploding."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.checks import domain, landing
from spendloom.checks.domain import with_
from spendloom.checks.functions import event_documents
from spendloom.checks.registry import check, table
from spendloom.checks.views import CONTACTS_VIEW, COURSE_VIEW, SURVEY_VIEW, typed_courses
from spendloom.contracts import Contract, day, money, text, whole
from spendloom.contracts.tables import FACEBOOK_ADS, GOOGLE_ADWORDS
from spendloom.functions.text import urn
from spendloom.operators import filters, joins, reshape
from spendloom.plans import views
from spendloom.plans.loads import adwords, engagement, facebook

AS_OF = "1999-06-30"

# --- projection -----------------------------------------------------------------


@check("proj_select_reorder", with_("responses") + "SELECT ANSWER, EMAIL, SEGMENT, RESPONSE_ID FROM responses")
def select_reorder(spark, sf):
    return domain.responses(spark, sf).select("ANSWER", "EMAIL", "SEGMENT", "RESPONSE_ID")


def adwords_report(spark, sf):
    """Line items as the text columns of the ad report."""
    ads = domain.google_adwords(spark, sf)
    header = {target: source for source, target in adwords.HEADERS.items()}
    shown = {c: F.col(c).cast("string") for c in GOOGLE_ADWORDS.names}
    shown |= {
        c: F.concat((F.col("CONVERSIONS") + 0.25).cast("decimal(18,2)").cast("string"), F.lit("%"))
        for c in adwords.PERCENTS
    }
    shown |= {c: (F.col("COST") * 1_000_000).cast("decimal(28,0)").cast("string") for c in adwords.MICROS}
    return ads.select(*[shown[c].alias(header[c]) for c in GOOGLE_ADWORDS.names])


@check(
    "proj_rename_positional",
    with_("google_adwords")
    + """SELECT CAST(AD_DATE AS VARCHAR) AS AD_DATE, CAST(AD_ID AS VARCHAR) AS AD_ID, HEADLINE,
    CAST(CLICKS AS VARCHAR) AS CLICKS FROM google_adwords""",
)
def rename_positional(spark, sf):
    named = reshape.select_renamed(adwords_report(spark, sf), adwords.HEADERS)
    return named.select("AD_DATE", "AD_ID", "HEADLINE", "CLICKS")


@check("proj_drop", with_("posts") + "SELECT POST_ID, POST_CHANNEL, CLICKS FROM posts")
def drop(spark, sf):
    gone = [c for c in domain.POST_COLUMNS if c not in ("POST_ID", "POST_CHANNEL", "CLICKS")]
    return domain.posts(spark, sf).drop(*gone)


@check("proj_const", "SELECT event_id, 'Social' AS PAID_SOCIAL, event_type AS CHANNEL FROM events")
def const(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", F.lit("Social").alias("PAID_SOCIAL"), F.col("event_type").alias("CHANNEL")
    )


@check("proj_load_stamp", "SELECT c_custkey, '1999-06-30' AS IMPORT_DATE FROM customer")
def load_stamp(spark, sf):
    return reshape.load_stamp(table(spark, sf, "customer").select("c_custkey"), "IMPORT_DATE", AS_OF)


@check(
    "proj_null_placeholder",
    with_("facebook_ads")
    + """SELECT AD_ID, CAST(NULL AS BIGINT) AS SOCIAL_CLICKS, CAST(NULL AS DOUBLE) AS SOCIAL_SPEND,
    CAST(SPEND AS DOUBLE) AS SPEND FROM facebook_ads""",
)
def null_placeholder(spark, sf):
    kept = domain.facebook_ads(spark, sf).select("AD_ID", "SPEND")
    dtypes = {f.name: f.dtype for f in FACEBOOK_ADS.fields}
    return reshape.null_columns(kept, {c: dtypes[c] for c in ("SOCIAL_CLICKS", "SOCIAL_SPEND")})


@check(
    "proj_flatten_struct",
    """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) - 50 AS a_k,
    CAST(json_extract_string(props, '$.k') AS BIGINT) > 50 AS a_on,
    CASE WHEN event_type = 'click' THEN 'click|x' ELSE '' END AS a_tags FROM events""",
)
def flatten(spark, sf):
    flat = reshape.flatten(event_documents(spark, sf), sep="_")
    return flat.select("event_id", "a_k", "a_on", F.array_join("a_tags", "|").alias("a_tags"))


# --- filters ----------------------------------------------------------------------


@check("flt_eq", "SELECT o_orderkey FROM orders WHERE o_orderstatus = 'O'")
def eq(spark, sf):
    return table(spark, sf, "orders").filter(F.col("o_orderstatus") == "O").select("o_orderkey")


_TYPED = "SELECT c_custkey, NULLIF(c_mktsegment, 'MACHINERY') AS kind FROM customer"


def _typed_customers(spark, sf):
    return table(spark, sf, "customer").select(
        "c_custkey", F.nullif(F.col("c_mktsegment"), F.lit("MACHINERY")).alias("kind")
    )


@check("flt_ne_nullsafe", f"SELECT * FROM ({_TYPED}) WHERE kind IS DISTINCT FROM 'HOUSEHOLD'")
def ne_nullsafe(spark, sf):
    return _typed_customers(spark, sf).filter(filters.differs(F.col("kind"), "HOUSEHOLD"))


@check(
    "flt_compound",
    f"SELECT * FROM ({_TYPED}) WHERE (kind <> 'HOUSEHOLD' AND c_custkey <> 7) OR kind = 'BUILDING'",
)
def compound(spark, sf):
    kind = F.col("kind")
    return _typed_customers(spark, sf).filter(
        ((kind != "HOUSEHOLD") & (F.col("c_custkey") != 7)) | (kind == "BUILDING")
    )


@check("flt_gt", with_("google_adwords") + "SELECT AD_ID, IMPRESSIONS FROM google_adwords WHERE IMPRESSIONS > 0")
def gt(spark, sf):
    return domain.google_adwords(spark, sf).filter(F.col("IMPRESSIONS") > 0).select("AD_ID", "IMPRESSIONS")


@check("flt_in", "SELECT event_id, event_type FROM events WHERE event_type IN ('click', 'view')")
def isin(spark, sf):
    return table(spark, sf, "events").filter(F.col("event_type").isin("click", "view")).select("event_id", "event_type")


_LOOKED_UP = """SELECT c_custkey, o_orderkey, o_orderdate FROM customer
    LEFT JOIN orders ON c_custkey = o_custkey AND o_orderstatus = 'P'"""


def _looked_up(spark, sf):
    stored = table(spark, sf, "orders").filter(F.col("o_orderstatus") == "P")
    return table(spark, sf, "customer").join(stored, F.col("c_custkey") == F.col("o_custkey"), "left")


@check("flt_is_null", f"SELECT c_custkey FROM ({_LOOKED_UP}) WHERE o_orderkey IS NULL")
def is_null(spark, sf):
    return _looked_up(spark, sf).filter(F.col("o_orderkey").isNull()).select("c_custkey")


@check(
    "flt_col_gt_col",
    """SELECT l_orderkey, l_partkey, CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS shipped FROM lineitem
    JOIN orders ON l_orderkey = o_orderkey WHERE l_shipdate > o_orderdate + INTERVAL 60 DAY""",
)
def col_gt_col(spark, sf):
    joined = table(spark, sf, "lineitem").join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    late = F.col("l_shipdate") > F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")
    return joined.filter(late).select("l_orderkey", "l_partkey", F.col("l_shipdate").cast("date").alias("shipped"))


@check(
    "flt_or_null",
    f"SELECT c_custkey, o_orderkey FROM ({_LOOKED_UP}) WHERE o_orderdate < DATE '{domain.CUTOFF}' OR o_orderkey IS NULL",
)
def or_null(spark, sf):
    early = F.col("o_orderdate") < F.lit(domain.CUTOFF).cast("timestamp_ntz")
    return _looked_up(spark, sf).filter(early | F.col("o_orderkey").isNull()).select("c_custkey", "o_orderkey")


@check(
    "flt_trailing_window",
    with_("facebook_ads")
    + """SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, AD_DATE < DATE '1999-06-30' AS complete
    FROM facebook_ads WHERE AD_DATE >= DATE '1999-06-30' - 150 AND AD_DATE <= DATE '1999-06-30'""",
)
def trailing_window(spark, sf):
    ads = filters.trailing_window(domain.facebook_ads(spark, sf), "AD_DATE", AS_OF, 150, include_today=True)
    complete = filters.trailing_window(ads, "AD_DATE", AS_OF, facebook.WINDOW_DAYS)
    # Days before the running one are the same with and without it.
    open_day = ads.filter(F.col("AD_DATE") == F.lit(AS_OF).cast("date"))
    older = filters.trailing_window(ads, "AD_DATE", F.date_sub(F.lit(AS_OF).cast("date"), facebook.WINDOW_DAYS), 120)
    done = complete.unionByName(older).select("AD_ID", "AD_DATE", F.lit(True).alias("complete"))
    return done.unionByName(open_day.select("AD_ID", "AD_DATE", F.lit(False).alias("complete")))


@check(
    "flt_scalar_subquery",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders
    WHERE CAST(o_orderdate AS DATE) < (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_returnflag = 'R')
      AND CAST(o_orderdate AS DATE) > (SELECT MIN(CAST(l_shipdate AS DATE)) FROM lineitem WHERE l_returnflag = 'R')""",
)
def scalar_subquery(spark, sf):
    shipped = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "R")
        .select(F.col("l_shipdate").cast("date").alias("d"))
    )
    ordered = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return ordered.filter(
        (F.col("day") < filters.largest(shipped, "d")) & (F.col("day") > filters.smallest(shipped, "d"))
    )


# --- joins --------------------------------------------------------------------------


@check(
    "join_inner_chain",
    """SELECT l_orderkey, o_custkey, p_partkey, p_brand FROM lineitem JOIN orders ON o_orderkey = l_orderkey
    JOIN part ON p_partkey = l_partkey""",
)
def inner_chain(spark, sf):
    link, orders, parts = (table(spark, sf, n) for n in ("lineitem", "orders", "part"))
    joined = link.join(orders, F.col("l_orderkey") == F.col("o_orderkey")).join(
        parts, F.col("l_partkey") == F.col("p_partkey")
    )
    return joined.select("l_orderkey", "o_custkey", "p_partkey", "p_brand")


@check(
    "join_left",
    with_("info", "programs")
    + "SELECT i.VID, LAST_NAME, ACADEMIC_PROGRAM FROM info i LEFT JOIN programs p ON i.VID = p.VID AND i.NUM_PAGE_VIEWS > 5",
)
def left(spark, sf):
    info = domain.contact_info(spark, sf).select("VID", "LAST_NAME", "NUM_PAGE_VIEWS")
    programs = domain.programs(spark, sf).select(F.col("VID").alias("_vid"), "ACADEMIC_PROGRAM")
    joined = info.join(programs, (F.col("VID") == F.col("_vid")) & (F.col("NUM_PAGE_VIEWS") > 5), "left")
    return joined.select("VID", "LAST_NAME", "ACADEMIC_PROGRAM")


@check("join_left_then_inner", f"SELECT VID, LAST_NAME, ACADEMIC_PROGRAM FROM ({CONTACTS_VIEW})")
def left_then_inner(spark, sf):
    return views.hubspot_contacts(
        {
            "HUBSPOT_CONTACTS_INFO": domain.contact_info(spark, sf),
            "HUBSPOT_CONTACTS_ACADEMIC_PROGRAMS": domain.programs(spark, sf),
            "HUBSPOT_CONTACTS": domain.staged_ids(spark, sf),
        }
    ).select("VID", "LAST_NAME", "ACADEMIC_PROGRAM")


@check(
    "join_left_expr",
    with_("contacts", "responses")
    + """SELECT c.VID, r.RESPONSE_ID, r.ANSWER FROM contacts c LEFT JOIN responses r
    ON UPPER(c.CU_EMAIL) = UPPER(r.EMAIL)""",
)
def left_expr(spark, sf):
    people = domain.contacts(spark, sf).select("VID", F.upper("CU_EMAIL").alias("_mail"))
    keyed = people.select("VID", joins.spread_key(F.col("_mail"), F.col("VID")).alias("_key"))
    answers = domain.responses(spark, sf).select(
        F.concat(F.lit("+"), F.upper("EMAIL")).alias("_key"), "RESPONSE_ID", "ANSWER"
    )
    return keyed.join(answers, "_key", "left").select("VID", "RESPONSE_ID", "ANSWER")


@check(
    "join_frame_left",
    """SELECT o_orderkey AS ID, o_orderstatus, l_partkey AS STORED FROM orders
    LEFT JOIN (SELECT DISTINCT l_orderkey, l_partkey FROM lineitem WHERE l_returnflag = 'A') ON o_orderkey = l_orderkey""",
)
def frame_left(spark, sf):
    current = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ID"), "o_orderstatus")
    stored = (
        table(spark, sf, "lineitem")
        .filter(F.col("l_returnflag") == "A")
        .select(F.col("l_orderkey").alias("ID"), F.col("l_partkey").alias("STORED"))
        .distinct()
    )
    return current.join(stored, "ID", "left")


@check(
    "join_semi",
    """SELECT o_orderkey, o_custkey FROM orders WHERE 'urn:li:sponsoredAccount:' || o_custkey IN
    (SELECT 'urn:li:sponsoredAccount:' || c_custkey FROM customer WHERE c_mktsegment <> 'HOUSEHOLD')""",
)
def semi(spark, sf):
    accounts = table(spark, sf, "customer").filter(F.col("c_mktsegment") != "HOUSEHOLD")
    prefix = "urn:li:sponsoredAccount:"
    campaigns = table(spark, sf, "orders").withColumn("account", urn(prefix, F.col("o_custkey")))
    kept = joins.matching_list(campaigns, F.col("account"), accounts, urn(prefix, F.col("c_custkey")))
    return kept.select("o_orderkey", "o_custkey")


def _nullable_key(df, key: str, null_when):
    return df.withColumn(key, F.when(~null_when, F.col(key)))


@check(
    "join_anti",
    """WITH src AS (SELECT CASE WHEN l_linenumber <> 3 THEN l_orderkey END AS k, l_partkey FROM lineitem),
    tgt AS (SELECT CASE WHEN o_orderstatus <> 'F' THEN o_orderkey END AS k FROM orders WHERE o_orderpriority <> '5-LOW')
    SELECT k, l_partkey FROM src WHERE NOT EXISTS (SELECT 1 FROM tgt WHERE tgt.k = src.k)""",
)
def anti(spark, sf):
    source = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("k"), "l_partkey", "l_linenumber")
    target = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderpriority") != "5-LOW")
        .select(F.col("o_orderkey").alias("k"), "o_orderstatus")
    )
    missing = joins.absent_rows(
        _nullable_key(source, "k", F.col("l_linenumber") == 3).select("k", "l_partkey"),
        _nullable_key(target, "k", F.col("o_orderstatus") == "F").select("k"),
        ["k"],
    )
    return missing


@check(
    "join_left_stale",
    """SELECT DISTINCT c.c_custkey AS VID FROM
    (SELECT c_custkey, CAST(TIMESTAMP '1998-01-01' AS TIMESTAMP) AS UPDATED_AT FROM customer) c
    LEFT JOIN orders o ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'P'
    WHERE c.UPDATED_AT < o.o_orderdate OR o.o_custkey IS NULL""",
)
def left_stale(spark, sf):
    stored = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("VID"), F.lit("1998-01-01").cast("timestamp_ntz").alias("UPDATED_AT")
    )
    loaded = (
        table(spark, sf, "orders")
        .filter(F.col("o_orderstatus") == "P")
        .select(F.col("o_custkey").alias("VID"), F.col("o_orderdate").alias("UPDATEDAT"))
    )
    return joins.stale_keys(stored, loaded, "VID", "UPDATED_AT", "UPDATEDAT")


@check(
    "join_fanout_lookup",
    """SELECT c_custkey AS ID, o_orderkey AS APP_ID, o_orderpriority AS SUBJECT, l_quantity::BIGINT AS PROCESSED
    FROM customer JOIN orders ON c_custkey = o_custkey JOIN lineitem ON l_orderkey = o_orderkey""",
)
def fanout_lookup(spark, sf):
    ids = (
        table(spark, sf, "customer")
        .join(table(spark, sf, "orders"), F.col("c_custkey") == F.col("o_custkey"))
        .select(F.col("c_custkey").alias("id"), F.col("o_orderkey").alias("appId"))
    )
    details = (
        table(spark, sf, "lineitem")
        .join(table(spark, sf, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
        .select(
            F.col("o_custkey").alias("id"),
            F.col("o_orderkey").alias("appId"),
            F.col("o_orderpriority").alias("subject"),
            *[F.lit(None).cast("string").alias(c) for c in ("name", "appName", "type", "processingState")],
            F.struct(*[F.col("l_quantity").cast("bigint").alias(c) for c in engagement.COUNTERS]).alias("counters"),
            F.lit(None).cast("bigint").alias("lastProcessingFinishedAt"),
        )
    )
    return engagement.email_campaigns(ids, details).select("ID", "APP_ID", "SUBJECT", "PROCESSED")


# --- aggregates -------------------------------------------------------------------------

_KEYS = ", ".join(views.COURSE_KEYS)


@check("agg_group_rollup", f"SELECT {_KEYS}, COURSE_COUNT, ENROLLMENTS FROM ({COURSE_VIEW})")
def group_rollup(spark, sf):
    rolled = views.course_rollup({"COGNOS_COURSE_LISTS_PRD": typed_courses(spark, sf)})
    return rolled.select(*views.COURSE_KEYS, "COURSE_COUNT", "ENROLLMENTS")


@check(
    "agg_product_of_sums",
    """SELECT l_returnflag, CAST(SUM(CAST(l_quantity AS BIGINT)) * SUM(CAST(l_linenumber + 0.5 AS DECIMAL(18,2)))
    AS DOUBLE) AS CREDIT_HOURS FROM lineitem GROUP BY l_returnflag""",
)
def product_of_sums(spark, sf):
    enrolled = F.col("l_quantity").cast("decimal(18,0)")
    units = (F.col("l_linenumber") + 0.5).cast("decimal(18,2)")
    return (
        table(spark, sf, "lineitem")
        .groupBy("l_returnflag")
        .agg((F.sum(enrolled) * F.sum(units)).alias("CREDIT_HOURS"))
    )


@check("agg_global_max", "SELECT CAST(MAX(CAST(l_shipdate AS DATE)) AS VARCHAR) AS newest FROM lineitem")
def global_max(spark, sf):
    """Of a stored table, from the files' statistics."""
    days = Contract("DAYS", (whole("AD_ID"), day("AD_DATE")))
    stored = landing.new_table(spark, days, domain.google_adwords(spark, sf).select("AD_ID", "AD_DATE"))
    return spark.range(1).select(filters.largest(stored, "AD_DATE").alias("newest"))


@check(
    "agg_distinct_cols",
    "SELECT DISTINCT o_custkey AS ID, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS CREATED_DATE FROM orders",
)
def distinct_cols(spark, sf):
    return (
        table(spark, sf, "orders")
        .select(F.col("o_custkey").alias("ID"), F.col("o_orderdate").cast("date").alias("CREATED_DATE"))
        .distinct()
    )


@check("agg_distinct_rows", "SELECT DISTINCT * FROM (SELECT lang, source FROM documents)")
def distinct_rows(spark, sf):
    return table(spark, sf, "documents").select("lang", "source").distinct()


# --- sort, set operations, explode ------------------------------------------------------


@check("sort_multi", f"SELECT * FROM ({COURSE_VIEW}) ORDER BY {_KEYS}")
def sort_multi(spark, sf):
    return views.course_rollup({"COGNOS_COURSE_LISTS_PRD": typed_courses(spark, sf)}, ordered=True)


_SPEND = Contract("SPEND", (text("PLATFORM"), whole("AD_ID"), day("AD_DATE"), money("COST"), whole("CONVERSIONS")))
_BRANCHES = """SELECT 'a' AS PLATFORM, AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CAST(COST AS DOUBLE) AS COST,
    CONVERSIONS FROM google_adwords
    UNION ALL SELECT 'f', AD_ID, CAST(AD_DATE AS VARCHAR), CAST(SPEND AS DOUBLE), TOTAL_ACTIONS FROM facebook_ads
    UNION ALL SELECT 'l', CREATIVE_ID, CAST(AD_DATE AS VARCHAR), CAST(COST AS DOUBLE), NULL FROM linkedin_ads"""


def _branches(spark, sf):
    google = domain.google_adwords(spark, sf).withColumn("PLATFORM", F.lit("a"))
    facebook_ = domain.facebook_ads(spark, sf).select(
        F.lit("f").alias("PLATFORM"),
        "AD_ID",
        "AD_DATE",
        F.col("SPEND").alias("COST"),
        F.col("TOTAL_ACTIONS").alias("CONVERSIONS"),
    )
    linkedin = domain.linkedin_ads(spark, sf).select(
        F.lit("l").alias("PLATFORM"), F.col("CREATIVE_ID").alias("AD_ID"), "AD_DATE", "COST"
    )
    return [google, facebook_, linkedin]


@check("set_union_all", with_("google_adwords", "facebook_ads", "linkedin_ads") + _BRANCHES)
def union_all(spark, sf):
    return reshape.union_branches(_SPEND, _branches(spark, sf))


@check("set_union_distinct", f"SELECT DISTINCT VID, EMAIL, SEGMENT, ANSWER FROM ({SURVEY_VIEW})")
def union_distinct(spark, sf):
    survey_ = views.contacts_with_survey(
        {"HUBSPOT_CONTACTS": domain.contacts(spark, sf), "ASK_NICELY_RESPONSES": domain.responses(spark, sf)}
    )
    return survey_.select("VID", "EMAIL", "SEGMENT", "ANSWER").distinct()


@check(
    "set_union_coerce",
    with_("linkedin_ads", "posts")
    + """SELECT CAST(CREATIVE_ID AS VARCHAR) AS AD_ID, CLICKS, CAST(NULL AS BIGINT) AS CONVERSIONS,
    CAST(COST AS DOUBLE) AS COST FROM linkedin_ads UNION ALL SELECT POST_ID, CLICKS, NULL, NULL FROM posts""",
)
def union_coerce(spark, sf):
    shape = Contract("COERCED", (text("AD_ID"), whole("CLICKS"), whole("CONVERSIONS"), money("COST")))
    linkedin = domain.linkedin_ads(spark, sf).select(F.col("CREATIVE_ID").alias("AD_ID"), "CLICKS", "COST")
    social = domain.posts(spark, sf).select(F.col("POST_ID").alias("AD_ID"), "CLICKS")
    return reshape.union_branches(shape, [linkedin, social])


@check("exp_multivalue", with_("programs") + "SELECT VID, ACADEMIC_PROGRAM FROM programs")
def multivalue(spark, sf):
    return reshape.explode_items(domain.program_lists(spark, sf), ["VID"], "PROGRAMS", "ACADEMIC_PROGRAM")


@check(
    "exp_child_array",
    """SELECT doc_id, UNNEST(STRING_SPLIT(text, ' ')) AS word FROM documents WHERE lang <> 'en'
    UNION ALL SELECT doc_id, UNNEST(STRING_SPLIT(text, chr(10))) FROM documents WHERE lang = 'en'""",
)
def child_array(spark, sf):
    docs = table(spark, sf, "documents")
    children = F.when(F.col("lang") == "en", F.split("text", "\n")).otherwise(F.split("text", " "))
    # An empty list after the children adds no row.
    every = docs.select("doc_id", children.alias("words")).unionByName(
        docs.select("doc_id", F.array().cast("array<string>").alias("words"))
    )
    return reshape.explode_children(every, [F.col("doc_id")], F.col("words"), "word")
