"""Keyed merges of a staged batch into a production table.

Each function returns rows; the caller appends or replaces.  Inserts only ever
append, so target files are not rewritten by them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.operators.filters import largest, smallest
from spendloom.operators.joins import absent_rows, all_present, left_join, without_keys
from spendloom.store import Table


def rows_to_insert(target: DataFrame, source: DataFrame, keys: list[str], prune_by: str | None = None) -> DataFrame:
    """Source rows for an insert-only merge.

    Existing keys are left alone, restated metrics included; every source row of
    a new key goes in.  ``prune_by`` names a day column among the keys: only the
    target days the batch spans are then read, as scalar subqueries that prune
    partitions.
    """
    if prune_by:
        span = (F.col(prune_by) >= smallest(source, prune_by)) & (F.col(prune_by) <= largest(source, prune_by))
        target = target.filter(span)
    return absent_rows(source, target, keys)


def merge_insert(target: DataFrame, source: DataFrame, keys: list[str], prune_by: str | None = None) -> DataFrame:
    """Content of the target after an insert-only merge."""
    return target.unionByName(rows_to_insert(target, source, keys, prune_by))


def unique_rows(source: DataFrame, keys: list[str]) -> DataFrame:
    """The batch's rows with whole keys, failing at run time if a key occurs twice.

    The check is part of the plan: duplicates meet in a pre-aggregated group, and
    the following join on the same keys reuses its partitioning.  It is a filter,
    so no plan can do without it.
    """
    rest = [c for c in source.columns if c not in keys]
    grouped = (
        source.filter(all_present(keys))
        .groupBy(*keys)
        .agg(F.first(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_n"))
    )
    duplicate = F.raise_error(F.concat(F.lit("duplicate source key "), F.to_json(F.struct(*keys))))
    once = F.when(F.col("_n") > 1, duplicate.cast("boolean")).otherwise(True)
    return grouped.filter(once).select(*keys, "_row.*").select(*source.columns)


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    update_cols: list[str],
    insert_map: Callable[[DataFrame], DataFrame] = lambda new: new,
) -> DataFrame:
    """Refresh ``update_cols`` of matched rows; insert the others through ``insert_map``.

    The target is the streamed side of a left join, so a small batch is
    broadcast and a hot target key can be split.  Refreshed and inserted rows both
    come from the checked batch; rows with a NULL key part match nothing, are not
    checked and go in.
    """
    batch = unique_rows(source, keys)
    fresh = batch.select(
        *[F.col(k).alias(f"_k_{k}") for k in keys], *[F.col(c).alias(f"_s_{c}") for c in update_cols]
    )
    match = [F.col(k) == F.col(f"_k_{k}") for k in keys]
    hit = F.col(f"_k_{keys[0]}").isNotNull()
    keyed = all_present(keys)
    joined = target.filter(keyed).join(fresh, match, "left")
    updated = joined.select(
        *[
            F.when(hit, F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c) if c in update_cols else F.col(c)
            for c in target.columns
        ]
    )
    added = insert_map(absent_rows(batch, target, keys).union(source.filter(~keyed)))
    return updated.unionByName(target.filter(~keyed)).unionByName(added)


def delete_matched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target without the keys of the batch."""
    return without_keys(target, source, keys)


def replace_by_key(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """All target rows of each batch key replaced by the batch's rows; keys need not be unique."""
    return delete_matched(target, source, keys).unionByName(source)


def delete_latest_day(target: DataFrame, day: str) -> DataFrame:
    """Target without its newest day, which may have been loaded while incomplete.

    Rows without a day stay, and an empty target stays empty.
    """
    newest = largest(target, day)
    return target.filter((F.col(day) != newest) | F.col(day).isNull())


def highwater_prune(staged: DataFrame, staged_day: str, target: DataFrame | Table, target_day: str) -> DataFrame:
    """Staged rows not older than the newest stored day; everything while nothing is stored.

    Of a stored table, the newest day comes from the files' statistics or folders.
    """
    mark = largest(target, target_day)
    return staged.filter((F.col(staged_day) >= mark) | mark.isNull() | F.col(staged_day).isNull())


def classify(source: DataFrame, stored: DataFrame, key: str, source_at: str, stored_at: str) -> DataFrame:
    """Source rows marked new, modified or unchanged against the stored copy."""
    known = stored.select(key, F.col(stored_at).alias("_at")).distinct()
    state = (
        F.when(F.col("_at").isNull(), "new").when(F.col(source_at) > F.col("_at"), "modified").otherwise("unchanged")
    )
    return left_join(source, known, [key]).select(*source.columns, state.alias("STATE"))


def delete_cascade(parent: DataFrame, child: DataFrame, ids: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Parent and child tables without the given ids."""
    return without_keys(parent, ids, [key]), without_keys(child, ids, [key])
