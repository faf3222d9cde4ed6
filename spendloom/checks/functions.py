"""Column expressions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.checks import domain
from spendloom.checks.domain import with_
from spendloom.checks.registry import check, table
from spendloom.functions import dates, lookups, numbers, paths, text
from spendloom.plans.loads import survey

# A zone seven hours behind UTC all year round.
TZ = "America/Phoenix"
_LOCAL = "(ts - INTERVAL 7 HOUR)"


@check(
    "fn_epoch_s_date",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders",
)
def epoch_s_date(spark, sf):
    day = F.unix_date(F.col("o_orderdate").cast("date")).cast("bigint")
    late = day * dates.SECONDS_PER_DAY + (dates.SECONDS_PER_DAY - 1)
    return table(spark, sf, "orders").select("o_orderkey", dates.epoch_s_date(late).alias("day"))


@check("fn_epoch_ms_date", "SELECT event_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS day FROM events")
def epoch_ms_date(spark, sf):
    # The number arrives as text.
    value = domain.millis("ts").cast("string")
    return table(spark, sf, "events").select("event_id", dates.epoch_ms_date(value).alias("day"))


@check(
    "fn_epoch_ms_ts",
    "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S') AS at FROM events",
)
def epoch_ms_ts(spark, sf):
    value = domain.millis("ts").cast("string")
    return table(spark, sf, "events").select("event_id", dates.epoch_ms_ts(value).alias("at"))


@check("fn_epoch_ms_local_date", f"SELECT event_id, CAST(CAST({_LOCAL} AS DATE) AS VARCHAR) AS day FROM events")
def epoch_ms_local_date(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.epoch_ms_local_date(domain.millis("ts"), TZ).alias("day"))


@check(
    "fn_epoch_ms_local_date_mirrored",
    """SELECT event_id, CAST(CAST(TIMESTAMP '1970-01-01 00:00:00' +
    (ts - TIMESTAMP '1970-01-01 00:00:00') - INTERVAL 7 HOUR AS DATE) AS VARCHAR) AS day FROM events""",
)
def epoch_ms_local_date_mirrored(spark, sf):
    # Times as far before 1970 as the events are after it.
    before = -domain.millis("ts")
    return table(spark, sf, "events").select("event_id", dates.epoch_ms_local_date(before, TZ, mirror=True).alias("day"))


@check("fn_epoch_ms_local_ts", f"SELECT event_id, strftime({_LOCAL}, '%Y-%m-%d %H:%M:%S') AS at FROM events")
def epoch_ms_local_ts(spark, sf):
    return table(spark, sf, "events").select("event_id", dates.epoch_ms_local_ts(domain.millis("ts"), TZ).alias("at"))


@check(
    "fn_report_date",
    "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day, CAST(NULL AS VARCHAR) AS bad FROM orders",
)
def report_date(spark, sf):
    digits = F.replace(F.col("o_orderdate").cast("date").cast("string"), F.lit("-"), F.lit(""))
    return table(spark, sf, "orders").select(
        "o_orderkey", dates.report_date(digits).alias("day"), dates.report_date(F.col("o_orderpriority")).alias("bad")
    )


@check(
    "fn_date_from_parts",
    """SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day,
    CAST(TRY_CAST(EXTRACT(YEAR FROM o_orderdate) || '-' || EXTRACT(MONTH FROM o_orderdate) || '-31' AS DATE) AS VARCHAR)
      AS last_day FROM orders""",
)
def date_from_parts(spark, sf):
    d = F.col("o_orderdate")
    return table(spark, sf, "orders").select(
        "o_orderkey",
        dates.date_from_parts(F.year(d), F.month(d), F.dayofmonth(d)).alias("day"),
        dates.date_from_parts(F.year(d), F.month(d), F.lit(31)).alias("last_day"),
    )


_START = "CAST(CAST(o_orderdate AS DATE) - 150 AS DATE)"


@check(
    "fn_date_offset",
    f"""SELECT o_orderkey, CAST({_START} AS VARCHAR) AS start_day, EXTRACT(YEAR FROM {_START}) AS start_year,
    EXTRACT(MONTH FROM {_START}) AS start_month, EXTRACT(DAY FROM {_START}) AS start_dom,
    date_diff('day', DATE '1970-01-01', {_START}) * 86400 AS start_epoch FROM orders""",
)
def date_offset(spark, sf):
    parts = dates.window_start_parts(F.col("o_orderdate").cast("date"), 150)
    return table(spark, sf, "orders").select("o_orderkey", *[c.alias(n) for n, c in parts.items()])


@check("fn_left", "SELECT doc_id, LEFT(text, 4) AS code FROM documents")
def left(spark, sf):
    return table(spark, sf, "documents").select("doc_id", text.leading(F.col("text"), 4).alias("code"))


@check(
    "fn_right_id",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, RIGHT('urn:li:sponsoredCampaign:' || (l_partkey + 100000000), 9)
      AS nine, CAST(l_partkey AS VARCHAR) AS digits FROM lineitem""",
)
def right_id(spark, sf):
    long_urn = text.urn("urn:li:sponsoredCampaign:", F.col("l_partkey") + 100_000_000)
    short_urn = text.urn("urn:li:sponsoredCampaign:", F.col("l_partkey"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        text.trailing(long_urn, 9).alias("nine"),
        text.trailing_digits(short_urn).alias("digits"),
    )


@check("fn_upper", "SELECT c_custkey, UPPER(LOWER(c_name)) AS email FROM customer")
def upper(spark, sf):
    return domain.contact_info(spark, sf).select(F.col("VID").alias("c_custkey"), F.upper("EMAIL").alias("email"))


@check("fn_concat_prefix", "SELECT s_suppkey, 'urn:li:sponsoredAccount:' || s_suppkey AS urn FROM supplier")
def concat_prefix(spark, sf):
    return table(spark, sf, "supplier").select(
        "s_suppkey", text.urn("urn:li:sponsoredAccount:", F.col("s_suppkey")).alias("urn")
    )


@check("fn_split_first", "SELECT page_id, SPLIT_PART(url, ':', 1) AS scheme FROM pages")
def split_first(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.first_part(F.col("url"), ":").alias("scheme"))


@check(
    "fn_split_list",
    with_("program_lists")
    + """SELECT VID, CAST(LEN(STRING_SPLIT(COALESCE(PROGRAMS, ''), ';')) AS BIGINT) AS n,
    STRING_SPLIT(COALESCE(PROGRAMS, ''), ';')[1] AS first FROM program_lists""",
)
def split_list(spark, sf):
    listed = text.items(F.col("PROGRAMS"))
    return domain.program_lists(spark, sf).select(
        "VID", F.size(listed).alias("n"), F.get(listed, F.lit(0)).alias("first")
    )


@check(
    "fn_replace_token",
    """SELECT doc_id, REPLACE(text || '(not set)', '(not set)', '') AS unset, REPLACE(lang || '(none)', '(none)', '')
      AS medium, REPLACE('(direct)' || source, '(direct)', 'direct') AS origin FROM documents""",
)
def replace_token(spark, sf):
    return table(spark, sf, "documents").select(
        "doc_id",
        text.remove(F.concat("text", F.lit(text.NOT_SET)), text.NOT_SET).alias("unset"),
        text.remove(F.concat("lang", F.lit(text.NO_MEDIUM)), text.NO_MEDIUM).alias("medium"),
        text.substitute(F.concat(F.lit(text.DIRECT), "source"), text.DIRECT, "direct").alias("origin"),
    )


@check("fn_strip_char", "SELECT page_id, REPLACE(REPLACE(html, '<', '|'), '|', '') AS stripped FROM pages")
def strip_char(spark, sf):
    piped = F.replace(F.col("html"), F.lit("<"), F.lit("|"))
    return table(spark, sf, "pages").select("page_id", text.remove(piped, "|").alias("stripped"))


@check(
    "fn_strip_markup",
    r"SELECT page_id, REPLACE(REPLACE(REPLACE(html, chr(10), ''), chr(13), ''), '<p>', '') AS body FROM pages",
)
def strip_markup(spark, sf):
    return table(spark, sf, "pages").select("page_id", text.strip_markup(F.col("html")).alias("body"))


@check(
    "fn_unescape",
    """SELECT page_id AS response_id, REPLACE(REPLACE(REPLACE(html, '&39;', ''), '&#39;', ''), '&amp;', 'and')
      AS comment FROM pages""",
)
def unescape(spark, sf):
    return survey.comments(
        table(spark, sf, "pages").select(F.col("page_id").alias("response_id"), F.col("html").alias("comment"))
    )


@check(
    "fn_percent",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CAST(l_discount AS DECIMAL(18,4)) / 100 AS DOUBLE) AS rate,
    CAST(NULL AS DOUBLE) AS bad FROM lineitem""",
)
def percent(spark, sf):
    shown = F.concat(F.col("l_discount").cast("decimal(18,2)").cast("string"), F.lit("%"))
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        numbers.percent(shown).alias("rate"),
        numbers.percent(F.col("l_returnflag")).alias("bad"),
    )


@check(
    "fn_micros",
    "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DOUBLE) AS cost FROM lineitem",
)
def micros(spark, sf):
    millionths = (F.col("l_extendedprice").cast("decimal(18,2)") * 1_000_000).cast("decimal(28,0)").cast("string")
    return table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", numbers.micros(millionths).alias("cost")
    )


@check(
    "fn_to_numeric",
    """SELECT event_id, TRY_CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k, CAST(NULL AS BIGINT) AS bad
      FROM events""",
)
def to_numeric(spark, sf):
    digits = F.regexp_extract("props", "([0-9]+)", 1)
    return table(spark, sf, "events").select(
        "event_id", numbers.to_number(digits).alias("k"), numbers.to_number(F.col("event_type")).alias("bad")
    )


@check(
    "fn_fill_zero",
    """SELECT event_id, CASE WHEN event_type = 'click' THEN user_id ELSE 0 END AS clicks,
    COALESCE(CASE WHEN event_type = 'view' THEN value END, 0) AS cost FROM events""",
)
def fill_zero(spark, sf):
    sparse = table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "click", F.col("user_id")).alias("clicks"),
        F.when(F.col("event_type") == "view", F.col("value")).alias("cost"),
    )
    return numbers.fill_zero(sparse, ["clicks", "cost"])


@check(
    "fn_safe_ratio",
    with_("google_adwords")
    + """SELECT AD_ID, CLICKS, IMPRESSIONS, CASE WHEN CLICKS = 0 OR IMPRESSIONS = 0 THEN 0.0
    ELSE ((2 * CLICKS * 1000 + IMPRESSIONS) // (2 * IMPRESSIONS)) / 1000.0 END AS ratio,
    CASE WHEN COST = 0 OR CLICKS = 0 THEN 0.0
    ELSE ((2 * CAST(COST * 100 AS BIGINT) + CLICKS) // (2 * CLICKS)) / 100.0 END AS cost_per_click,
    CAST(CASE WHEN IMPRESSIONS = 0 THEN 0 END AS DOUBLE) AS missing
    FROM google_adwords""",
)
def safe_ratio(spark, sf):
    clicks, shown = F.col("CLICKS"), F.col("IMPRESSIONS")
    return domain.google_adwords(spark, sf).select(
        "AD_ID",
        "CLICKS",
        "IMPRESSIONS",
        numbers.safe_ratio(clicks, shown, 10, 3).alias("ratio"),
        numbers.safe_ratio(F.col("COST"), clicks, 10, 2).alias("cost_per_click"),
        numbers.safe_ratio(F.lit(None).cast("decimal(18,0)"), shown, 10, 3).alias("missing"),
    )


@check(
    "fn_cast_decimal",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_extendedprice,
    ((CAST(l_extendedprice * 100 AS BIGINT) + 5) // 10) / 10.0 AS tenths FROM lineitem""",
)
def cast_decimal(spark, sf):
    # Halves round away from zero.
    return table(spark, sf, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_extendedprice",
        F.col("l_extendedprice").cast("decimal(18,2)").cast("decimal(18,1)").alias("tenths"),
    )


_GUIDS = {"click": "MSIS", "view": "BAPS", "signup": "MCJ"}
_CHANNELS = {"click": "GooglePlusPage", "view": "FacebookPage", "signup": "LinkedInCompanyPage"}


@check(
    "fn_case_lookup",
    """SELECT event_id,
    CASE event_type WHEN 'click' THEN 'MSIS' WHEN 'view' THEN 'BAPS' WHEN 'signup' THEN 'MCJ' ELSE 'CU Online' END
      AS program,
    CASE event_type WHEN 'click' THEN 'Google Plus' WHEN 'view' THEN 'Facebook' WHEN 'signup' THEN 'LinkedIn'
      ELSE event_type END AS channel,
    n_name AS nation
    FROM events LEFT JOIN nation ON n_nationkey = user_id""",
)
def case_lookup(spark, sf):
    guid = {program: guid for guid, program in lookups.CAMPAIGN_PROGRAMS.items()}
    kind = F.col("event_type")
    ids = {k: guid[p] for k, p in _GUIDS.items()}
    mapped = table(spark, sf, "events").select(
        "event_id",
        lookups.campaign_program(lookups.map_values(kind, ids, kind)).alias("program"),
        lookups.channel_name(lookups.map_values(kind, _CHANNELS, kind)).alias("channel"),
        F.col("user_id").cast("string").alias("nation"),
    )
    nations = table(spark, sf, "nation").withColumn("n_nationkey", F.col("n_nationkey").cast("string"))
    return lookups.lookup(mapped, "nation", nations, "n_nationkey", "n_name", F.lit(None).cast("string"))


@check(
    "fn_case_program",
    """WITH named AS (SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, CASE
      WHEN l_linenumber = 1 THEN 'Master Criminal Justice MCJ' WHEN l_linenumber = 2 THEN 'MC J'
      WHEN l_linenumber = 3 THEN 'M CJ' WHEN l_linenumber = 4 THEN 'CUON' WHEN l_linenumber = 5 THEN 'CU Online'
      ELSE l_returnflag END AS p FROM lineitem)
    SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey,
    CASE WHEN p IN ('Master Criminal Justice MCJ', 'MC J') THEN 'MCJ' ELSE p END AS adwords,
    CASE WHEN p IN ('Master Criminal Justice MCJ', 'MC J') THEN 'MCJ'
         WHEN p IN ('CUON', 'CU Online') THEN 'CU Online' ELSE p END AS linkedin,
    CASE WHEN p = 'CUON' THEN 'CU Online' WHEN p IN ('Master Criminal Justice MCJ', 'M CJ') THEN 'MCJ' ELSE p END
      AS facebook FROM named""",
)
def case_program(spark, sf):
    n = F.col("l_linenumber")
    spelled = (
        F.when(n == 1, "Master Criminal Justice MCJ")
        .when(n == 2, "MC J")
        .when(n == 3, "M CJ")
        .when(n == 4, "CUON")
        .when(n == 5, "CU Online")
        .otherwise(F.col("l_returnflag"))
    )
    named = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", spelled.alias("p"))
    return named.select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        lookups.program_name(F.col("p"), "Google Adwords").alias("adwords"),
        lookups.program_name(F.col("p"), "LinkedIn").alias("linkedin"),
        lookups.program_name(F.col("p"), "Facebook").alias("facebook"),
    )


# --- nested values --------------------------------------------------------------

_DOCUMENT = (
    "a struct<k bigint, on boolean, tags array<string>, "
    "props map<string, struct<value string, versions array<struct<value string, timestamp bigint>>>>>"
)


def event_documents(spark, sf):
    """One JSON text per event, parsed with a declared schema.

    The number is the event's property minus 50, so it is sometimes 0; the map
    lacks its only key for errors, and purchases have no versions.
    """
    events = table(spark, sf, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    kind = F.col("event_type")
    entry = F.struct(
        F.when(kind == "view", "").otherwise(F.concat(kind, F.lit("\n<p>"), F.col("user_id"))).alias("value"),
        F.when(
            kind != "purchase",
            F.array(
                F.struct(kind.alias("value"), domain.millis("ts").alias("timestamp")),
                F.struct(F.lit("old").alias("value"), F.lit(0).alias("timestamp")),
            ),
        )
        .otherwise(F.array())
        .alias("versions"),
    )
    document = F.to_json(
        F.struct(
            F.struct(
                (k - 50).alias("k"),
                (k > 50).alias("on"),
                F.when(kind == "click", F.array(kind, F.lit("x"))).otherwise(F.array()).alias("tags"),
                F.when(kind != "error", F.create_map(F.lit("stage"), entry)).otherwise(F.create_map()).alias("props"),
            ).alias("a")
        )
    )
    return events.select("event_id", F.from_json(document, _DOCUMENT).alias("d")).select("event_id", "d.*")


_K = "CAST(json_extract_string(props, '$.k') AS BIGINT)"
_STAGE = "CASE WHEN event_type NOT IN ('error', 'view') THEN event_type || {sep} || user_id END"


@check(
    "proj_path_value",
    f"""SELECT event_id, NULLIF({_K} - 50, 0) AS k, {_K} - 50 AS k_kept, CASE WHEN {_K} > 50 THEN TRUE END AS is_on,
    {_K} > 50 AS on_kept, CASE WHEN event_type = 'click' THEN 'click' END AS tag,
    CASE WHEN event_type = 'click' THEN 2 END::BIGINT AS tags, CAST(NULL AS VARCHAR) AS beyond,
    {_STAGE.format(sep="chr(10) || '<p>'")} AS stage FROM events""",
)
def path_value(spark, sf):
    docs = event_documents(spark, sf)
    return docs.select(
        "event_id",
        paths.path_value(docs, ("a", "k")).alias("k"),
        paths.path_value(docs, ("a", "k"), keep_falsy=True).alias("k_kept"),
        paths.path_value(docs, ("a", "on")).alias("is_on"),
        paths.path_value(docs, ("a", "on"), keep_falsy=True).alias("on_kept"),
        paths.path_value(docs, ("a", "tags", 0)).alias("tag"),
        F.size(paths.path_value(docs, ("a", "tags"))).alias("tags"),
        paths.path_value(docs, ("a", "tags", 2)).alias("beyond"),
        paths.path_value(docs, ("a", "props", "stage", "value")).alias("stage"),
    )


@check(
    "proj_path_value_clean",
    f"SELECT event_id, CAST(NULLIF({_K} - 50, 0) AS VARCHAR) AS k, "
    + _STAGE.format(sep="''")
    + " AS stage FROM events",
)
def path_value_clean(spark, sf):
    docs = event_documents(spark, sf)
    return docs.select(
        "event_id",
        paths.path_value_clean(docs, ("a", "k")).alias("k"),
        paths.path_value_clean(docs, ("a", "props", "stage", "value")).alias("stage"),
    )


@check(
    "proj_latest_version",
    """SELECT event_id, CASE WHEN event_type NOT IN ('error', 'purchase') THEN event_type END AS stage,
    CASE WHEN event_type NOT IN ('error', 'purchase') THEN epoch_us(ts) // 1000 END AS stage_at FROM events""",
)
def latest_version(spark, sf):
    docs = event_documents(spark, sf)
    value, at = paths.latest_version(docs, ("a", "props", "stage"))
    return docs.select("event_id", value.alias("stage"), at.alias("stage_at"))
