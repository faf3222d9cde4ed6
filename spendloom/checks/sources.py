"""Readers, writers, contracts and rejects, over files written from whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from spendloom.checks import domain, landing
from spendloom.checks.domain import with_
from spendloom.checks.relational import adwords_report
from spendloom.checks.registry import check, table
from spendloom.contracts.tables import (
    ASK_NICELY_RESPONSES,
    FACEBOOK_ADS,
    HUBSPOT_SOCIAL_POSTS,
    MARKETING_ETL_ERRORS,
    STG_FACEBOOK_ADS_0818,
)
from spendloom.operators import rejects
from spendloom.plans.loads import adwords, content, courses, survey
from spendloom.session import scratch_path
from spendloom.sources.pages import CORRUPT, read_array, read_documents, read_pages
from spendloom.sources.tabular import POSITIONAL_PAGE, read_csv_report, read_table, rows_to_columns
from spendloom.streaming.incremental import Remember, landed_pages, merge_new_files, read_target

# --- sources -----------------------------------------------------------------------


@check(
    "src_json_envelope",
    """SELECT o_orderkey AS id, UNNEST(range(1, EXTRACT(MONTH FROM o_orderdate))) AS n, o_orderpriority AS name,
    o_custkey AS account FROM orders""",
)
def json_envelope(spark, sf):
    # One page per order; January's pages are empty.
    counted = F.sequence(F.lit(1), F.lit(11))
    months = F.month("o_orderdate")
    pages = table(spark, sf, "orders").select(
        F.col("o_custkey").alias("account"),
        F.transform(
            F.filter(counted, lambda n: n < months),
            lambda n: F.struct(F.col("o_orderkey").alias("id"), n.alias("n"), F.col("o_orderpriority").alias("name")),
        ).alias("elements"),
    )
    path = landing.land_documents(pages, "envelope")
    return read_pages(
        spark, path, "elements", "id bigint, n bigint, name string", context={"account": "bigint"}, **landing.LINES
    )


@check(
    "src_json_array",
    """SELECT event_id AS id, event_type, user_id, CAST(NULL AS VARCHAR) AS rejected FROM events WHERE event_id % 100 <> 42
    UNION ALL SELECT NULL, NULL, NULL, '{"id":"event ' || event_id || '","event_type":"' || event_type || '","user_id":' || user_id || '}'
    FROM events WHERE event_id % 100 = 42""",
)
def json_array(spark, sf):
    """Arrays of a hundred events, one of them with a text as its id."""
    sent = table(spark, sf, "events").select(F.col("event_id").alias("id"), "event_type", "user_id", "event_id")
    path = landing.land_with_faults(sent, "event_id", "event", None, "array")
    torn = []
    rows = read_array(spark, path, "id bigint, event_type string, user_id bigint", unreadable=torn.append, **landing.LINES)
    faulty = torn[0].select(F.col(CORRUPT).alias("rejected")).filter("rejected IS NOT NULL")
    return rows.unionByName(faulty, allowMissingColumns=True)


@check("src_json_object", "SELECT page_id, url, html FROM pages")
def json_object(spark, sf):
    entry = F.struct(F.col("html").alias("value"))
    docs = table(spark, sf, "pages").select("page_id", "url", F.create_map(F.lit("body"), entry).alias("properties"))
    path = landing.land_documents(docs, "documents")
    read = read_documents(
        spark, path, "page_id bigint, url string, properties map<string, struct<value string>>", **landing.LINES
    )
    return read.select("page_id", "url", F.col("properties")["body"]["value"].alias("html"))


@check(
    "src_positional_rows",
    """SELECT CAST(l_orderkey AS VARCHAR) AS ad, l_returnflag AS flag, CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) AS n,
    CAST(NULL AS VARCHAR) AS beyond FROM lineitem""",
)
def positional_rows(spark, sf):
    row = F.array(
        F.col("l_orderkey").cast("string"), F.col("l_returnflag"), F.col("l_quantity").cast("bigint").cast("string")
    )
    path = landing.land_documents(table(spark, sf, "lineitem").select(F.array(row).alias("rows")), "matrix")
    pages = read_documents(spark, path, POSITIONAL_PAGE, **landing.LINES)
    return rows_to_columns(pages, ("ad", "flag", "n", "beyond"))


@check(
    "src_csv_report",
    with_("google_adwords")
    + """SELECT CAST(AD_DATE AS VARCHAR) AS day, CAST(AD_ID AS VARCHAR) AS ad,
    CASE WHEN AD_ID % 50 = 3 THEN HEADLINE || chr(10) || ', "second" line' ELSE HEADLINE END AS headline,
    CAST(CONVERSIONS AS VARCHAR) || '.25%' AS ctr, NULL::VARCHAR AS rejected FROM google_adwords WHERE AD_ID % 100 <> 42
    UNION ALL SELECT NULL, NULL, NULL, NULL, 'ad ' || AD_ID FROM google_adwords WHERE AD_ID % 100 = 42""",
)
def csv_report(spark, sf):
    """Some headlines span two lines; some lines end in a value with a stray quote, and go to the rejects."""
    two = F.concat(F.col("`Headline 1`"), F.lit('\n, "second" line'))
    spans, stray = F.col("`Ad ID`") % 50 == 3, F.col("`Ad ID`") % 100 == 42
    sent = adwords_report(spark, sf).withColumn("Headline 1", F.when(spans & ~stray, two).otherwise(F.col("`Headline 1`")))
    values = [F.col(f"`{c}`") for c in sent.columns[:-1]]
    line = F.to_csv(F.struct(*values, F.col(f"`{sent.columns[-1]}`")), {"escape": '"'})
    torn = F.concat(F.to_csv(F.struct(*values), {"escape": '"'}), F.lit(',"ad '), F.col("`Ad ID`"))
    path = landing.land_csv_lines(sent, F.when(stray, torn).otherwise(line), "report")
    torn_lines = []
    report = read_csv_report(spark, path, tuple(adwords.HEADERS), unreadable=torn_lines.append)
    shown = report.select(
        F.col("Day").alias("day"),
        F.col("Ad ID").alias("ad"),
        F.col("Headline 1").alias("headline"),
        F.col("CTR").alias("ctr"),
    )
    faulty = torn_lines[0].select(F.regexp_extract(CORRUPT, "ad [0-9]+$", 0).alias("rejected"))
    return shown.unionByName(faulty, allowMissingColumns=True)


@check("src_table", "SELECT o_custkey AS VID, o_orderkey FROM orders")
def stored_table(spark, sf):
    ids = read_table(spark, f"{sf}/orders.parquet", ["o_custkey", "o_orderkey"])
    return ids.withColumnRenamed("o_custkey", "VID")


_LANDED = "SELECT RESPONSE_ID, CAST(RESPONSE_DATE AS VARCHAR) AS RESPONSE_DATE, EMAIL, ANSWER FROM responses"


@check("src_incremental_landing", with_("responses") + _LANDED)
def incremental_landing(spark, sf):
    return landed_twice(spark, sf)


@check("src_incremental_landing_remembered", with_("responses") + _LANDED)
def incremental_landing_remembered(spark, sf):
    # Half of the days are inside the window; rows of the others meet stored ones.
    days = domain.responses(spark, sf).select(F.min("RESPONSE_DATE"), F.max("RESPONSE_DATE")).first()
    arrived = F.lit(days[1]).cast("timestamp")
    return landed_twice(spark, sf, Remember("RESPONSE_DATE", (days[1] - days[0]).days // 2, arrived))


def landed_twice(spark, sf, remember=None):
    path = scratch_path(spark, "incoming")
    target, checkpoint = scratch_path(spark, "loaded"), scratch_path(spark, "progress")
    sent = survey_records(spark, sf)

    def drop(rows):
        page = rows.select(F.array(F.struct(*rows.columns)).alias("data"))
        page.write.mode("append").json(path)

    def load():
        records = landed_pages(spark, path, "data", survey.RECORD, multi_line=False)
        prepare = lambda batch: survey.extract(batch, "2100-01-01", 100_000).good
        merge_new_files(
            records, prepare, target, checkpoint, ASK_NICELY_RESPONSES, survey.KEYS, "RESPONSE_DATE", remember=remember
        ).awaitTermination()

    # The second drop repeats the first one's responses; the third run finds no file.
    drop(sent.filter(F.col("segment") != "1-URGENT"))
    load()
    drop(sent)
    load()
    load()
    return read_target(spark, target, ASK_NICELY_RESPONSES).select("RESPONSE_ID", "RESPONSE_DATE", "EMAIL", "ANSWER")


def survey_records(spark, sf):
    """Orders as survey responses in source fields."""
    answers = domain.responses(spark, sf)
    noon = (F.unix_date("RESPONSE_DATE").cast("bigint") * 86_400) + 43_200
    return landing.as_text(
        answers.select(
            F.col("RESPONSE_ID").alias("response_id"),
            noon.alias("responded"),
            F.col("NAME").alias("name"),
            F.col("SEGMENT").alias("segment"),
            F.col("EMAIL").alias("email"),
            F.col("ANSWER").alias("answer"),
            F.lit("fine &amp; good").alias("comment"),
        )
    )


# --- sinks -------------------------------------------------------------------------


_POSTS = "SELECT POST_ID, POST_CHANNEL, CAST(CREATED_DATE AS VARCHAR) AS CREATED_DATE, CLICKS FROM posts"
_POST_COLUMNS = ("POST_ID", "POST_CHANNEL", "CREATED_DATE", "CLICKS")


@check("sink_truncate_load", with_("posts") + _POSTS)
def truncate_load(spark, sf):
    posts = domain.posts(spark, sf)
    staged = landing.new_table(spark, HUBSPOT_SOCIAL_POSTS, posts.withColumn("CLICKS", F.lit(0)))
    staged.replace(posts)
    return staged.read().select(*_POST_COLUMNS)


@check(
    "sink_delete_reload",
    "SELECT p_name AS KEYWORD, p_partkey AS VISITS, CAST(p_size AS BIGINT) + 1 AS LEADS FROM part",
)
def delete_reload(spark, sf):
    words = table(spark, sf, "part").select(
        F.col("p_name").alias("KEYWORD"), F.col("p_partkey").alias("VISITS"), F.col("p_size").alias("LEADS")
    )
    stored = landing.new_table(spark, content.HS_KEYWORDS, words)
    # The reload may derive from what is stored.
    stored.replace(stored.read().withColumn("LEADS", F.col("LEADS") + 1))
    stored.prune(keep=1)
    return stored.read().select("KEYWORD", "VISITS", "LEADS")


@check("sink_append", with_("posts") + _POSTS + " UNION ALL " + _POSTS)
def append(spark, sf):
    posts = domain.posts(spark, sf)
    stored = landing.new_table(spark, HUBSPOT_SOCIAL_POSTS)
    stored.append(posts)
    stored.append(posts)
    return stored.read().select(*_POST_COLUMNS)


@check(
    "sink_partitioned_append",
    with_("facebook_ads") + "SELECT AD_ID, CAST(AD_DATE AS VARCHAR) AS AD_DATE, CLICKS FROM facebook_ads",
)
def partitioned_append(spark, sf):
    stored = landing.new_table(spark, FACEBOOK_ADS)
    # One partition per year.
    yearly = domain.facebook_ads(spark, sf).withColumns(
        {"OBJECTIVE": F.col("AD_DATE").cast("string"), "AD_DATE": F.trunc("AD_DATE", "year")}
    )
    stored.append(yearly)
    return stored.read().select("AD_ID", F.col("OBJECTIVE").alias("AD_DATE"), "CLICKS")


@check(
    "sink_rejects",
    """SELECT event_id, CASE WHEN event_type = 'error' THEN 'unreadable' END AS ERROR_TEXT,
    CASE WHEN event_type = 'error' THEN '{"event_id": ' || event_id || ', "k' END AS CSV_DATA,
    CASE WHEN event_type = 'error' THEN FALSE END AS TRUNCATED,
    CASE WHEN event_type <> 'error' THEN CAST(json_extract_string(props, '$.k') AS BIGINT) END AS k FROM events""",
)
def rejected(spark, sf):
    # Error events land as cut-off lines.
    line = F.concat(F.lit('{"event_id": '), F.col("event_id"), F.lit(', "k'))
    whole_ = F.concat(line, F.lit('": '), F.get_json_object("props", "$.k"), F.lit("}"))
    path = scratch_path(spark, "lines")
    lines = table(spark, sf, "events").select(F.when(F.col("event_type") == "error", line).otherwise(whole_))
    lines.write.text(path)
    read = read_documents(spark, path, "event_id bigint, k bigint", multi_line=False, keep_corrupt=True)
    good, bad = rejects.split_unreadable(read)
    stored = landing.new_rejects(spark)
    stored.append(bad)
    none = F.lit(None)
    shown = stored.read().select(
        F.regexp_extract("CSV_DATA", "([0-9]+)", 1).cast("bigint").alias("event_id"),
        F.split_part("ERROR_TEXT", F.lit(","), F.lit(1)).alias("ERROR_TEXT"),
        "CSV_DATA",
        "TRUNCATED",
        none.cast("bigint").alias("k"),
    )
    return shown.unionByName(
        good.select(
            "event_id",
            none.cast("string").alias("ERROR_TEXT"),
            none.cast("string").alias("CSV_DATA"),
            none.cast("boolean").alias("TRUNCATED"),
            "k",
        )
    )


@check(
    "sink_error_log",
    """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS ETL_DATE, 'load_' || user_id AS FILE_NAME, props AS ERROR_MSG
    FROM events WHERE event_type = 'error'""",
)
def error_log(spark, sf):
    failed = table(spark, sf, "events").filter(F.col("event_type") == "error")
    log = landing.new_table(spark, MARKETING_ETL_ERRORS)
    step = F.concat(F.lit("load_"), F.col("user_id"))
    log.append(rejects.failures(failed, F.col("ts"), step, F.col("props")))
    return log.read()


@check("sink_skip_empty", with_("responses") + "SELECT RESPONSE_ID, ANSWER, FALSE AS wrote FROM responses")
def skip_empty(spark, sf):
    stored = landing.new_table(spark, ASK_NICELY_RESPONSES, domain.responses(spark, sf))
    wrote = stored.append_nonempty(stored.read().filter(F.col("ANSWER") < 0))
    return stored.read().select("RESPONSE_ID", "ANSWER", F.lit(wrote).alias("wrote"))


@check("dml_truncate", "SELECT COUNT(*) AS n, 'before' AS state FROM events UNION ALL SELECT 0, 'after'")
def truncate(spark, sf):
    stored = landing.new_table(spark, HUBSPOT_SOCIAL_POSTS, domain.posts(spark, sf))
    before = stored.read().agg(F.count(F.lit(1)).alias("n"), F.lit("before").alias("state"))
    stored.truncate()
    return before.unionByName(stored.read().agg(F.count(F.lit(1)).alias("n"), F.lit("after").alias("state")))


# --- contracts ---------------------------------------------------------------------


@check(
    "contract_table",
    """SELECT o_orderkey AS AD_ID,
    CASE WHEN o_orderstatus = 'P' AND o_orderpriority = '5-LOW'
           THEN 'ADSET_NAME: longer than 255; CLICKS: not a decimal(18,0)'
         WHEN o_orderstatus = 'P' THEN 'CLICKS: not a decimal(18,0)'
         WHEN o_orderpriority = '5-LOW' THEN 'ADSET_NAME: longer than 255' END AS problem,
    CASE WHEN o_orderstatus <> 'P' AND o_orderpriority <> '5-LOW' THEN CAST(o_totalprice AS DOUBLE) END AS SPEND
    FROM orders""",
)
def contract_table(spark, sf):
    sent = table(spark, sf, "orders").select(
        F.col("o_orderkey").cast("string").alias("AD_ID"),
        F.when(F.col("o_orderstatus") == "P", "n/a").otherwise("12").alias("CLICKS"),
        F.when(F.col("o_orderpriority") == "5-LOW", F.repeat(F.lit("x"), 256)).otherwise("").alias("ADSET_NAME"),
        F.col("o_orderdate").cast("date").cast("string").alias("DATE_START"),
        F.col("o_totalprice").cast("decimal(18,2)").cast("string").alias("SPEND"),
        "o_orderkey",
    )
    checked = STG_FACEBOOK_ADS_0818.enforce(sent, row_nr="o_orderkey")
    staged, stored = landing.new_table(spark, STG_FACEBOOK_ADS_0818), landing.new_rejects(spark)
    staged.stage(checked, stored)
    fine = staged.read().select("AD_ID", F.lit(None).cast("string").alias("problem"), "SPEND")
    return fine.unionByName(
        stored.read().select(
            F.col("ROW_NR").alias("AD_ID"),
            F.col("ERROR_TEXT").alias("problem"),
            F.lit(None).cast("decimal(18,2)").alias("SPEND"),
        )
    )


@check(
    "contract_course_typed",
    """SELECT CAST(l_orderkey AS VARCHAR) AS CLASS_NUM, l_returnflag AS CAMPUS_CD,
    CAST(EXTRACT(YEAR FROM l_shipdate) AS BIGINT) AS ACADEMIC_YEAR, CAST(l_quantity AS BIGINT) AS ENRL_TOT,
    CAST(l_linenumber + 0.5 AS DOUBLE) AS UNITS_MAXIMUM FROM lineitem WHERE l_returnflag <> 'R'
    UNION ALL SELECT CAST(l_orderkey AS VARCHAR), 'UNITS_MAXIMUM: not a decimal(18,2)', NULL, NULL, NULL FROM lineitem
    WHERE l_returnflag = 'R'""",
)
def contract_course_typed(spark, sf):
    units = F.when(F.col("CAMPUS_CD") == "R", "variable").otherwise(F.col("UNITS_MAXIMUM"))
    listed = domain.courses_text(spark, sf).withColumn("UNITS_MAXIMUM", units)
    checked = courses.typed(listed, F.col("ACADEMIC_YEAR"))
    return checked.good.select("CLASS_NUM", "CAMPUS_CD", "ACADEMIC_YEAR", "ENRL_TOT", "UNITS_MAXIMUM").unionByName(
        checked.bad.select(
            F.get_json_object("CSV_DATA", "$.CLASS_NUM").alias("CLASS_NUM"),
            F.col("ERROR_TEXT").alias("CAMPUS_CD"),
            F.lit(None).cast("decimal(18,0)").alias("ACADEMIC_YEAR"),
            F.lit(None).cast("decimal(18,0)").alias("ENRL_TOT"),
            F.lit(None).cast("decimal(18,2)").alias("UNITS_MAXIMUM"),
        )
    )
