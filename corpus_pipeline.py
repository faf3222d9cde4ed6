"""A training corpus from ``documents``, by five of the operators; each stage is written as Parquet and read again.

Every stage takes ``(spark, docs, sf_dir)``.  All but the last return the columns of ``docs``; the last returns the
packed pieces.  Order matters: texts without a language go before they are compared, copies go before passages are cut
from what is left, and texts change before they are packed.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendloom.llm import fmindex, jaccard, langid, packing, sanitise
from spendloom.llm.common import fresh, table, written
from spendloom.session import tune

#: A document is rejected if no letter tells its language, or if no language has so much of it.
LEAST_LANGUAGE = 0.4


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without documents of no discernible language."""
    language, score = fresh(docs, "language"), fresh(docs, "language_score")
    found = langid.predict(docs, langid.fit(docs), into=(language, score))
    kept = found.where((F.col(language) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def unlike(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that n-gram Jaccard links: the one of the least id, of several such rows the first."""
    return jaccard.representatives(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Without the benchmark's passages."""
    return fmindex.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def private(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """With personal data masked."""
    return sanitise.sanitise(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces in sequences, with a checksum of their ids."""
    return packing.pack(docs, keep_ids=False, added=True).drop("ids")


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", identified),
    ("jaccard", unlike),
    ("decontamination", decontaminated),
    ("personal data", private),
    ("packing", packed),
]

#: Recurrent networks, suffix ranks and packing are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents."""
    tune(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
