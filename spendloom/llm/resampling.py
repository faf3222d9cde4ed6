"""Importance resampling towards a target text, ranked by a distributed radix sort.

Features are runs of words, hashed to buckets; a bucket's gain is the log ratio of its smoothed shares in the target and
in the raw texts, and a row's weight is the sum of its features' gains, looked up in one array.  Noise by a hash of the
row's id is added (Gumbel), so that the highest scores are a draw without replacement in proportion to the weights.

The ranks come from least-significant-digit radix passes over the composite key: score descending, id, number of
features.  A pass counts digits by block of rows, turns the counts into global prefix offsets, and gives every row its
destination: the offset of its block and digit, and its place among the block's rows of that digit, in the order of the
last pass.  Destinations make the next pass's blocks, so a pass is one shuffle of short rows, no task holds more than a
block, and no global order is made anywhere.  Only the bits in which the keys differ are sorted.

Defined results: null and empty texts have no words, weight 0, and are never drawn; a null id counts as an empty string
in the hash, and as the least id; rows of one id are rows of their own; equal scores go by id, then by fewer features;
rows equal in all three are alike and share their ranks in any order; an empty table gives no rows; with nothing in the
target, or nothing in the raw texts, the shares are those of the smoothing alone.  Other columns don't matter.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, merged, pick, written

BUCKETS = 10_000
BATCH_BYTES = 1 << 20
#: Words a task remembers the hash of.
CACHE_WORDS = 1 << 17
#: A block is 2 ** ``BLOCK_BITS`` rows at most.
BLOCK_BITS = 13
DIGIT_BITS = 14

FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))


class Buckets(dict):
    """Bucket of a feature by its bytes."""

    def __init__(self, n: int):
        super().__init__()
        self.n = n

    def __missing__(self, feature: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        bucket = self[feature] = zlib.crc32(feature) % self.n
        return bucket

    def of(self, text: bytes | None, longest: int) -> np.ndarray:
        words = (text or b"").translate(FOLD).split()
        features = list(words)
        for k in range(2, longest + 1):
            features += [b" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
        return np.fromiter(map(self.__getitem__, features), np.int64, len(features))


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def counts(docs: DataFrame, buckets: int = BUCKETS, longest: int = 1) -> np.ndarray:
    """How often features of all texts fall in each bucket."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, total = Buckets(buckets), np.zeros(buckets, np.int64)
        for batch in batches:
            for text in _texts(batch):
                total += np.bincount(found.of(text, longest), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    found = map_batches(pick(docs, "text"), work, "bucket int, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in found.collect():  # at most one row for each bucket
        out[bucket] = n
    return out


def gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of smoothed shares, rounded down."""
    s, t = int(raw.sum()), int(target.sum())
    return np.array(
        [
            math.floor(1000 * math.log((b + 1) * (s + len(raw)) / ((a + 1) * (t + len(raw)))))
            for a, b in zip(raw.tolist(), target.tolist(), strict=True)
        ],
        np.int64,
    )


def weighted(docs: DataFrame, gain: np.ndarray, longest: int = 1) -> DataFrame:
    """``doc_id, n_words, n_features, weight`` of every row."""
    table = docs.sparkSession.sparkContext.broadcast(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gain, found = table.value, Buckets(len(table.value))
        for batch in merged(batches, BATCH_BYTES):
            own = [found.of(text, longest) for text in _texts(batch)]
            n = np.fromiter(map(len, own), np.int64, len(own))
            weight = np.fromiter((gain[x].sum() for x in own), np.int64, len(own))
            words = n if longest == 1 else np.array([len((t or b"").translate(FOLD).split()) for t in _texts(batch)], np.int64)
            columns = [batch.column("doc_id"), pa.array(words), pa.array(n), pa.array(weight)]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_words", "n_features", "weight"])

    return map_batches(
        pick(docs, "doc_id", "text"), work, "doc_id bigint, n_words bigint, n_features bigint, weight bigint"
    )


def noise(key: Column, seed: int) -> Column:
    """Thousandths of a Gumbel variate by the hash of the id, rounded down."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0)))).cast("bigint")


def _sorted_bits(rows: DataFrame, keys: list[str]) -> dict[str, tuple[Column, int]]:
    """Of each key a column in whose low bits, unsigned, the order of the key's values is, and how many bits these are."""
    ends = rows.agg(*[f(k).alias(f"{k}_{i}") for k in keys for i, f in enumerate((F.min, F.max))]).first()
    out = {}
    for k in keys:
        low, high = ends[f"{k}_0"], ends[f"{k}_1"]
        if low is None:
            out[k] = F.lit(0), 0
        elif high - low < 1 << 62:
            out[k] = F.col(k) - F.lit(low), (high - low).bit_length()
        else:
            out[k] = F.col(k).bitwiseXOR(F.lit(-(1 << 63))), 64  # signed order, with the top bit turned
    return out


def radix_ranks(rows: DataFrame, keys: list[str], digit_bits: int = DIGIT_BITS, block_bits: int = BLOCK_BITS) -> DataFrame:
    """``rows`` with ``place``: from 0 in the order of ``keys`` (bigint, none null, the first weighs most).

    ``rows`` must be a written table: its first order is the order in which it is read.
    """
    spark = rows.sparkSession
    rows = rows.select("*", F.monotonically_increasing_id().alias("place"))
    found = list(_sorted_bits(rows, keys).values())
    if not any(bits for _, bits in found):
        found[-1] = found[-1][0], 1  # one pass makes the places of alike rows gapless
    for key, bits in [(c, b) for c, b in found[::-1] if b]:
        passes = -(-bits // digit_bits)
        width = -(-bits // passes)
        for low in range(0, bits, width):
            digit = F.shiftrightunsigned(key, low).bitwiseAND(F.lit((1 << min(width, bits - low)) - 1)).cast("int")
            cut = rows.withColumn("block", F.shiftright("place", block_bits)).withColumn("digit", digit)
            cut = written(cut, "digits")
            counted = written(cut.groupBy("block", "digit").agg(F.count("*").alias("n")), "counts")
            totals = sorted(counted.groupBy("digit").agg(F.sum("n")).collect())  # at most 2^digit_bits rows
            ends = np.cumsum([0, *(n for _, n in totals)]).tolist()
            bases = spark.createDataFrame(
                [(d, base) for (d, _), base in zip(totals, ends[:-1], strict=True)], "digit int, base bigint"
            )
            before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
            offsets = (
                counted.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
                .join(bases, "digit")
                .select("block", "digit", (F.col("base") + F.col("before")).alias("offset"))
            )
            cell = Window.partitionBy("block", "digit").orderBy("place")
            moved = cut.withColumn("nth", F.row_number().over(cell)).join(offsets, ["block", "digit"])
            rows = moved.withColumn("place", F.col("offset") + F.col("nth") - 1).drop("block", "digit", "offset", "nth")
    return rows


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = BUCKETS,
    seed: int = 2024,
) -> DataFrame:
    """``doc_id, n_features, weight, score, rank``: all rows of ``docs``, the drawn ones with their rank (from 1).

    Of the rows with ``least_words`` words or more, ``percent`` of a hundred (rounded down) are drawn.
    """
    gain = gains(counts(docs, buckets, longest), counts(target, buckets, longest))
    scored = weighted(docs, gain, longest).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = written(scored, "scored")
    able = (
        scored.where(F.col("n_words") >= least_words)
        .withColumn("falling", F.bitwise_not("score"))
        .withColumn("key", F.coalesce("doc_id", F.lit(-(1 << 63))))
    )
    able = written(able, "able")
    drawn = percent * able.count() // 100
    ranked = radix_ranks(able, ["falling", "key", "n_features"])
    rank = F.when(F.col("place") < drawn, F.col("place") + 1)
    columns = ["doc_id", "n_features", "weight", "score"]
    rest = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("bigint").alias("rank"))
    return ranked.select(*columns, rank.alias("rank")).unionByName(rest)
