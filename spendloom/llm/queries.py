"""The operators over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.llm import (
    bottomk,
    chat,
    fmindex,
    hosttext,
    jaccard,
    langid,
    licences,
    oracles,
    packing,
    reconcile,
    resampling,
    sanitise,
    shallot,
    toxicity,
)
from spendloom.llm.common import learns, pick, table
from spendloom.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {
    "op11_centroid_clustering": oracles.clustering(),
    "op12_resampling": oracles.resampling(),
    "op13_near_duplicates": oracles.near_duplicates(),
}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = lambda spark, sf_dir: f(tune(spark), sf_dir)
    return f


@query
def op1_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reconcile.neighbour_edits(table(spark, sf_dir, "documents"))


@query
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    found = fmindex.leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = pick(table(spark, sf_dir, "documents"), "doc_id", "text")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        (~learns(F.col("doc_id"))).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )


@query
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.predict(pick(docs, "doc_id", "text"), langid.fit(docs))
    return found.select("doc_id", (~learns(F.col("doc_id"))).alias("held_out"), "lang_pred", "score")


@query
def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.groups(table(spark, sf_dir, "documents"))


@query
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), keep_ids=False, added=True).drop("ids")


@query
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sanitise.find(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda x: x["kind"] < sanitise.KINDS.index("term"))

    def count(k: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("bigint").alias(f"n_{kind}")

    counts = [count(k, kind) for k, kind in enumerate(sanitise.PATTERNS)]
    return found.withColumn("base", base).select(
        "doc_id",
        *counts,
        F.sha2(sanitise.joined_spans(F.col("base")).cast("binary"), 256).alias("base_sha256"),
        sanitise.joined_spans(F.col("spans")).alias("spans"),
    )


@query
def op7_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string"
    )
    rows = pick(table(spark, sf_dir, "conversations"), "conv_id", "turn", "role", "text").unionByName(extra)
    payload = F.expr("to_variant_object(struct(conv_id, turn, role, text))")
    read = chat.read_back(chat.formatted(chat.turns(rows.select(F.col("conv_id").alias("record"), payload.alias("payload")))))
    turns = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    learned = F.array_join("learned", "")
    return read.select(
        "conv_id",
        F.size("turns").cast("bigint").alias("n_turns"),
        F.sha2(F.array_join(turns, "").cast("binary"), 256).alias("turns_sha256"),
        F.length(learned).cast("bigint").alias("loss_chars"),
        F.sha2(learned.cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query
def op9_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(table(spark, sf_dir, "documents"))


@query
def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = hosttext.extract(table(spark, sf_dir, "pages"))
    return text.withColumn("n_chars", F.length("text").cast("bigint"))


@query
def op11_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = shallot.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, dims=64, scale=1024, seed=3)
    return found.withColumn("cluster", F.col("cluster").cast("bigint"))  # as SQL numbers clusters


@query
def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resampling.resample(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), percent=10, least_words=20, seed=2024
    )


@query
def op13_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bottomk.groups(table(spark, sf_dir, "documents"))
