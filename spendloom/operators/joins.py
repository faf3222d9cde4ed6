"""Joins for keyed loads.

No join here carries a broadcast hint: Catalyst and AQE broadcast a side only
after checking its size, and split hot partitions of the others.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def all_present(keys: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in keys])


def spread_key(key: Column, *spread: Column) -> Column:
    """Join key in which every missing key is its own value.

    NULL keys match nothing, yet an outer join would still send all of them to
    one task.  The two prefixes keep real keys and stand-ins apart.
    """
    stand_in = F.concat(F.lit("-"), F.xxhash64(*spread).cast("string"))
    return F.when(key.isNotNull(), F.concat(F.lit("+"), key)).otherwise(stand_in)


def present_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct source keys that occur in the target.

    The target is the left side of a semi-join, so a small batch is broadcast
    to it and the target's keys are never shuffled.
    """
    wanted = source.select(*keys).filter(all_present(keys)).distinct()
    return target.select(*keys).join(wanted, keys, "left_semi").distinct()


def absent_rows(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks.

    A key with a NULL part matches nothing, so those rows are always absent;
    they bypass the join rather than meet in one task.
    """
    keyed = all_present(keys)
    unmatched = source.filter(keyed).join(present_keys(target, source, keys), keys, "left_anti")
    return unmatched.select(*source.columns).union(source.filter(~keyed))


def without_keys(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose key is not in the source; rows with a NULL key part stay."""
    keyed = all_present(keys)
    gone = source.select(*keys).filter(keyed).distinct()
    kept = target.filter(keyed).join(gone, keys, "left_anti").select(*target.columns)
    return kept.union(target.filter(~keyed))


def left_join(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Left join on equal names in which a hot key can be split on either side.

    AQE splits both sides of an inner join, but only the left one of a left
    join.  So matches come from an inner join, the rows without a match from an
    anti-join with the distinct keys, and rows with a missing key pass by.
    """
    keyed = all_present(keys)
    present = left.filter(keyed)
    matched = present.join(right, keys)
    alone = present.join(right.select(*keys).distinct(), keys, "left_anti")
    rest = alone.select(*left.columns).union(left.filter(~keyed))
    return matched.unionByName(rest, allowMissingColumns=True)


#: Most keys that a sketch may call hot.
MOST_HOT = 1024


def hot_values(df: DataFrame, key: str, spread: int) -> DataFrame:
    """Values that more than one in ``spread`` rows has, and over how many salts to deal them: ``key, _salts``.

    A heavy-hitter sketch finds them, in one pass that shuffles a sketch for each
    task; at most ``MOST_HOT`` values come out.
    """
    most = min(spread, MOST_HOT)
    sketch = df.agg(F.expr(f"approx_top_k(`{key}`, {most}, {10 * most})").alias("_top"), F.count(F.lit(1)).alias("_n"))
    each = sketch.select("_n", F.explode("_top").alias("_t"))
    salts = F.ceil(F.col("_t.count") * spread / F.col("_n")).cast("int").alias("_salts")
    return each.select(F.col("_t.item").alias(key), salts).filter(F.col(key).isNotNull() & (F.col("_salts") > 1))


def salted_left_join(left: DataFrame, right: DataFrame, key: str, sample: DataFrame | None = None) -> DataFrame:
    """Left join in which a hot key of the right side is dealt over many tasks.

    AQE can't split the right side of a left join.  So rows of hot keys get a
    salt there, and a left row of such a key meets every salt; of its rows without
    a match, which other salts have, none is kept, as a hot key has a match.  The
    keys are found when the join runs; ``sample`` is where, if not in ``right``.
    """
    spark = left.sparkSession
    spread = max(64, int(spark.conf.get("spark.sql.shuffle.partitions")))
    # Bounded by MOST_HOT rows.
    hot = F.broadcast(hot_values(right if sample is None else sample, key, spread))
    number = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in right.columns]), F.coalesce("_salts", F.lit(1))).cast("int")
    dealt = right.join(hot, key, "left").withColumn("_salt", number).drop("_salts").withColumn("_hit", F.lit(True))
    every = F.explode(F.sequence(F.lit(0), F.coalesce("_salts", F.lit(1)) - 1))
    joined = left.join(hot, key, "left").withColumn("_salt", every).join(dealt, [key, "_salt"], "left")
    return joined.filter("_salts IS NULL OR _hit").drop("_salts", "_salt", "_hit")


def matching_list(df: DataFrame, key: Column, ids: DataFrame, id_key: Column) -> DataFrame:
    """Rows whose (computed) key is in an id list, each once."""
    wanted = ids.select(id_key.alias("_id")).distinct()
    return df.join(wanted, key == F.col("_id"), "left_semi")


def stale_keys(
    stored: DataFrame, loaded: DataFrame, key: str, stored_at: str, loaded_at: str, stale=Column.__lt__
) -> DataFrame:
    """Distinct keys with no loaded row, or for which ``stale(stored_at, loaded_at)`` holds.

    Both sides are reduced to distinct keys and times before the join.
    """
    seen = loaded.select(key, F.col(loaded_at).alias("_at"), F.lit(True).alias("_seen")).distinct()
    joined = left_join(stored.select(key, stored_at).distinct(), seen, [key])
    due = stale(F.col(stored_at), F.col("_at")) | F.col("_seen").isNull()
    return joined.filter(due).select(key).distinct()
