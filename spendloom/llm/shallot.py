"""Centroid clustering of integer vectors by bounded nearest-centroid search (Lloyd's rounds, exact).

Between rounds every vector keeps its centroid, the second-nearest one, an upper bound of the distance to the first and
a lower bound of the distance to all others.  When the centroids have moved, the bounds move with them; a vector whose
upper bound stays below its lower bound, or below half the way to the next centroid, is settled without a distance.  For the
others the distances to both remembered centroids are taken and the search starts from the closer one, at distance d:
a centroid that beats the second-best distance r lies in the ball of radius d + r round the start, so the start's
neighbours are scanned by distance until the ball ends, and every find that improves r shrinks the ball.  Distances are
compared as whole numbers (ties: smaller number); bounds are floating point with slack.

The vectors with their state are one table, written anew each round (the one before is removed); a task adds its sums by
centroid to its rows, so a round reads the vectors once.  What is shuffled is one sum for each task, centroid and
component, however often a vector repeats.  Centroids (k times the components) are all the driver holds.

Defined results: vectors of another size, null ones, and ones with a component that is null, not finite, or beyond
``LARGEST`` after scaling (whose squared distances leave 64 bits) are not kept and have no row.  Rows of one id are
vectors of their own.  Starting centroids of one hash go by their components; a null id comes last.  With fewer kept
vectors than clusters, all of them start; without any there are no rows.  Other columns don't matter.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, pick, written

LARGEST = 1 << 27
#: Relative slack of floating-point bounds.
SLACK = 1e-9

STATE = "vec_id bigint, vector array<int>, first int, second int, upper double, lower double, distance bigint"
SUMS = "cluster int, n bigint, inertia decimal(38,0), sums array<bigint>"


class Centroids:
    """Centroids of a round: their distances to each other, neighbours in order, and how far each has moved."""

    def __init__(self, now: np.ndarray, before: np.ndarray | None):
        self.now = now
        self.apart = np.sqrt(squared(now[:, None, :], now[None, :, :]).astype(float))
        self.order = np.argsort(self.apart, axis=1, kind="stable")
        k = len(now)
        off = self.apart + np.diag(np.full(k, np.inf))
        self.half = off.min(axis=1) / 2 if k > 1 else np.full(k, np.inf)
        self.moved = np.zeros(k) if before is None else np.sqrt(squared(now, before).astype(float))
        # The most that any other centroid has moved.
        ranked = np.argsort(-self.moved, kind="stable")
        self.others = np.full(k, self.moved[ranked[0]])
        if k > 1:
            self.others[ranked[0]] = self.moved[ranked[1]]


def squared(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    gap = x.astype(np.int64) - y
    return np.einsum("...i,...i->...", gap, gap)


def search(x: np.ndarray, first, second, upper, lower, c: Centroids) -> np.ndarray:
    """Brings ``first, second, upper, lower`` of the vectors up to date, in place; returns which vectors were searched."""
    k = len(c.now)
    if k == 1:
        first[:], second[:], upper[:], lower[:] = 0, 0, 0, np.inf
        return np.zeros(len(x), bool)
    upper += c.moved[first]
    lower -= c.others[first]
    np.maximum(lower, 2 * c.half[first] - upper, out=lower)
    open_ = ~(upper * (1 + SLACK) < lower * (1 - SLACK))
    at = np.flatnonzero(open_)
    # The exact distance to the own centroid may be enough.
    near = squared(x[at], c.now[first[at]])
    upper[at] = np.sqrt(near)
    lower[at] = np.maximum(lower[at], 2 * c.half[first[at]] - upper[at])
    still = ~(upper[at] * (1 + SLACK) < lower[at] * (1 - SLACK))
    at, near = at[still], near[still]
    if not len(at):
        return open_
    own = x[at]
    a, b = first[at].astype(np.int64), second[at].astype(np.int64)
    next_ = squared(own, c.now[b])
    swap = (next_ < near) | ((next_ == near) & (b < a))
    a, b = np.where(swap, b, a), np.where(swap, a, b)
    near, next_ = np.where(swap, next_, near), np.where(swap, near, next_)
    start, other, reach = a.copy(), b.copy(), np.sqrt(near)
    alive = np.arange(len(at))
    for place in range(k):
        candidate = c.order[start[alive], place]
        ball = (reach[alive] + np.sqrt(next_[alive])) * (1 + SLACK)
        inside = c.apart[start[alive], candidate] <= ball
        alive, candidate = alive[inside], candidate[inside]
        if not len(alive):
            break
        new = (candidate != other[alive]) & (candidate != start[alive])
        rows, centroid = alive[new], candidate[new]
        d = squared(own[rows], c.now[centroid])
        best = (d < near[rows]) | ((d == near[rows]) & (centroid < a[rows]))
        closer = ~best & ((d < next_[rows]) | ((d == next_[rows]) & (centroid < b[rows])))
        for which, to_second in ((best, False), (closer, True)):
            r, j, e = rows[which], centroid[which], d[which]
            if not to_second:
                b[r], next_[r], a[r], near[r] = a[r], near[r], j, e
            else:
                b[r], next_[r] = j, e
    first[at], second[at], upper[at], lower[at] = a, b, np.sqrt(near), np.sqrt(next_)
    return open_


def kept_vectors(vectors: DataFrame, dims: int, scale: int) -> DataFrame:
    """``vec_id, vector``: whole-number vectors of the rows that are kept."""
    double = F.transform(F.col("embedding"), lambda x: x.cast("double") * F.lit(float(scale)))
    rows = pick(vectors, "vec_id", "embedding").where(F.size("embedding") == dims).withColumn("scaled", double)
    # NaN is greater than any number; a null makes the test null.
    bad = F.exists("scaled", lambda x: F.coalesce((x >= F.lit(float(LARGEST))) | (x < F.lit(-float(LARGEST))), F.lit(True)))
    return rows.where(~bad).select("vec_id", F.transform("scaled", lambda x: F.floor(x).cast("int")).alias("vector"))


def seeds(kept: DataFrame, k: int, seed: int) -> np.ndarray:
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")).cast("binary"), 256)
    rows = kept.orderBy(digest.asc_nulls_last(), "vector").select("vector").limit(k).collect()
    return np.array([r.vector for r in rows], np.int64)


def _round(rows: DataFrame, centroids: Centroids, name: str) -> DataFrame:
    """All vectors assigned, and a row of sums for each task and centroid (written)."""
    shared = rows.sparkSession.sparkContext.broadcast(centroids)
    names = [f.split()[0] for f in f"{STATE}, {SUMS}".split(", ")]
    state, sums = names[:7], names[7:]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = shared.value
        k, dims = c.now.shape
        n, inertia, total = np.zeros(k, np.int64), [0] * k, np.zeros((k, dims), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("vector").flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
            first, second = (np.array(batch.column(i)) for i in ("first", "second"))
            upper, lower = (np.array(batch.column(i)) for i in ("upper", "lower"))
            search(x, first, second, upper, lower, c)
            distance = squared(x, c.now[first])
            for j in np.unique(first).tolist():
                own = first == j
                n[j] += own.sum()
                inertia[j] += sum(distance[own].tolist())
                total[j] += x[own].sum(axis=0, dtype=np.int64)
            none = [pa.nulls(len(x), t) for t in (pa.int32(), pa.int64(), pa.decimal128(38, 0), pa.list_(pa.int64()))]
            columns = [batch.column("vec_id"), batch.column("vector"), *map(pa.array, (first, second, upper, lower, distance)), *none]
            yield pa.RecordBatch.from_arrays(columns, names)
        some = np.flatnonzero(n)
        kinds = [pa.int64(), pa.list_(pa.int32()), pa.int32(), pa.int32(), pa.float64(), pa.float64(), pa.int64()]
        columns = [pa.nulls(len(some), t) for t in kinds]
        columns += [pa.array(some.astype(np.int32)), pa.array(n[some])]
        columns += [pa.array([inertia[j] for j in some], pa.decimal128(38, 0))]
        columns += [pa.array(total[some].tolist(), pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names)

    return written(map_batches(rows.select(*state), work, f"{STATE}, {SUMS}"), name)


def _sums(table: DataFrame, k: int, dims: int) -> tuple[list[int], list[int], list[list[int]]]:
    """Members, inertia and componentwise sums of each centroid: at most k times ``dims`` rows reach the driver."""
    own = table.where(F.col("cluster").isNotNull())
    n, inertia, sums = [0] * k, [0] * k, [[0] * dims for _ in range(k)]
    parts = own.select("cluster", "n", "inertia", F.posexplode("sums").alias("i", "part"))
    wide = F.sum(F.col("part").cast("decimal(38,0)")).alias("total")
    counted = F.sum(F.when(F.col("i") == 0, F.col("n"))), F.sum(F.when(F.col("i") == 0, F.col("inertia")))
    for j, i, total, members, distance in parts.groupBy("cluster", "i").agg(wide, *counted).collect():
        sums[j][i] = int(total)
        if i == 0:
            n[j], inertia[j] = int(members), int(distance)
    return n, inertia, sums


def _remove(df: DataFrame) -> None:
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        folder = spark._jvm.org.apache.hadoop.fs.Path(file).getParent()
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def cluster(
    vectors: DataFrame, k: int = 8, rounds: int = 10, dims: int = 64, scale: int = 1024, seed: int = 3
) -> DataFrame:
    """``vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256`` of every kept vector.

    ``vectors`` has vec_id and embedding.  Every round assigns all vectors and replaces each non-empty centroid by the
    floored mean of its vectors; after the last they are assigned once more.  Distances are squared.
    """
    spark = vectors.sparkSession
    kept = written(kept_vectors(vectors, dims, scale), "vectors")
    now = seeds(kept, k, seed)
    if not len(now):
        return kept.select(
            "vec_id",
            F.lit(0).alias("cluster"),
            *[F.lit(0).cast("bigint").alias(c) for c in ("distance", "cluster_inertia", "inertia")],
            F.lit("").alias("centroid_sha256"),
        )
    start = [F.lit(0).alias("first"), F.lit(min(1, len(now) - 1)).alias("second")]
    bounds = [F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"), F.lit(0).cast("bigint").alias("distance")]
    rows, before = kept.select("*", *start, *bounds), None
    for turn in range(rounds + 1):
        table = _round(rows, Centroids(now, before), f"round-{turn}")
        if turn:
            _remove(rows)
        rows = table.where(F.col("cluster").isNull())
        n, inertia, sums = _sums(table, len(now), dims)
        if turn < rounds:
            new = [[s // n[j] for s in sums[j]] if n[j] else now[j].tolist() for j in range(len(now))]
            now, before = np.array(new, np.int64), now
    whole = sum(inertia)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in now.tolist()]
    found = spark.createDataFrame(
        [(j, inertia[j], whole, digests[j]) for j in range(len(now))],
        "first int, cluster_inertia bigint, inertia bigint, centroid_sha256 string",
    )
    return (
        rows.select("vec_id", "first", "distance")
        .join(F.broadcast(found), "first")
        .select("vec_id", F.col("first").alias("cluster"), "distance", "cluster_inertia", "inertia", "centroid_sha256")
    )
