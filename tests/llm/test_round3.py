"""Centroid clustering, resampling and bottom-k near duplicates against SQL, brute force, and odd rows."""

import collections
import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from compare import compare, duck
from spendloom.llm import bottomk, queries, resampling, shallot, stars
from spendloom.llm.common import table, written

DOCS = "doc_id bigint, text string"
VECTORS = "vec_id bigint, embedding array<double>"
ODD = [
    (1, None),
    (2, ""),
    (3, " \t\n "),
    (4, "one two"),
    (4, "one two"),
    (5, "One TWO"),
    (None, "one two three four five six seven"),
    (6, "one two three four five six seven"),
    (7, "word " * 30000),
    (8, " ".join(f"w{i}" for i in range(40000))),
    (9, "é" * 5 + " ünï ß"),
]


@pytest.mark.parametrize("name", ["op11_centroid_clustering", "op12_resampling", "op13_near_duplicates"])
@pytest.mark.parametrize("sf", ["0.001", "0.01"])
def test_against_sql(spark, name, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    assert compare(entry.queries()[name](spark, sf_dir), duck(sf_dir), entry.oracle_sql()[name]) is None


# --- clustering ---------------------------------------------------------------


def brute_clusters(rows, k, rounds, dims, scale, seed):
    kept = []
    for key, v in rows:
        if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v):
            q = [math.floor(scale * x) for x in v]
            if all(-shallot.LARGEST <= x < shallot.LARGEST for x in q):
                kept.append((key, q))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(f"{seed}:{r[0]}".encode()).hexdigest(), r[1]))
    centroids = [q for _, q in order[:k]]

    def nearest(q):
        return min((sum((a - b) ** 2 for a, b in zip(q, c, strict=True)), j) for j, c in enumerate(centroids))

    for _ in range(rounds):
        own = collections.defaultdict(list)
        for _, q in kept:
            own[nearest(q)[1]].append(q)
        for j, members in own.items():
            centroids[j] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    found = [(key, *nearest(q)) for key, q in kept]
    inertia = collections.Counter()
    for _, d, j in found:
        inertia[j] += d
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return collections.Counter((key, j, d, inertia[j], sum(inertia.values()), digests[j]) for key, d, j in found)


def clusters(df, **parameters):
    return collections.Counter(map(tuple, shallot.cluster(df, **parameters).collect()))


def test_odd_vectors(spark):
    rng = np.random.default_rng(5)
    rows = [(i, (rng.integers(-3, 4, 4) / 2).tolist()) for i in range(300)]
    rows += [(7, [0.5, 0.5, 0.5, 0.5])] * 40 + [(None, [1.0, 2.0, 3.0, 4.0])] * 2
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0, None, 1.0, 1.0]), (404, [math.nan, 1.0, 1.0, 1.0])]
    rows += [(405, [math.inf, 1.0, 1.0, 1.0]), (406, [1e300, 1.0, 1.0, 1.0]), (407, [-1e9, 0.0, 0.0, 0.0]), (408, [9e6, -9e6, 0.0, 0.0])]
    df = spark.createDataFrame(rows, VECTORS)
    for k, rounds in ((8, 10), (1, 2), (40, 6)):
        p = {"k": k, "rounds": rounds, "dims": 4, "scale": 8, "seed": 3}
        assert clusters(df, **p) == brute_clusters(rows, **p)


def test_fewer_vectors_than_clusters_and_clashing_columns(spark):
    rows = [(1, [0.0, 1.0]), (2, [5.0, 1.0]), (2, [5.0, 1.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>")
    df = df.withColumn("first", F.lit("x")).withColumn("VECTOR", F.lit(1)).withColumn("cluster", F.lit(None))
    p = {"k": 8, "rounds": 3, "dims": 2, "scale": 1024, "seed": 3}
    assert clusters(df, **p) == brute_clusters(rows, **p)
    assert clusters(df.where("false"), **p) == {}


def test_search_takes_few_distances():
    """Settled vectors are skipped, and whatever the bounds skip, the result is the full search's."""
    rng = np.random.default_rng(2)
    middles = rng.integers(-2000, 2000, (20, 16))
    x = (middles[rng.integers(0, 20, 4000)] + rng.integers(-60, 60, (4000, 16))).astype(np.int32)
    now, before = x[:20].astype(np.int64), None
    first, second = np.zeros(len(x), np.int32), np.ones(len(x), np.int32)
    upper, lower = np.full(len(x), np.inf), np.zeros(len(x))
    open_ = []
    for _ in range(12):
        open_.append(shallot.search(x, first, second, upper, lower, shallot.Centroids(now, before)).sum())
        full = shallot.squared(x[:, None, :], now[None])
        assert (full.argmin(axis=1) == first).all()
        assert (np.sqrt(full.min(axis=1)) <= upper * (1 + 1e-9)).all()
        rest = full.copy()
        rest[np.arange(len(x)), first] = 1 << 60
        assert (np.sqrt(rest.min(axis=1)) >= lower * (1 - 1e-9)).all()
        means = [x[first == j].astype(np.int64).sum(axis=0) // max(1, (first == j).sum()) if (first == j).any() else now[j] for j in range(20)]
        now, before = np.array(means), now
    assert open_[0] == len(x) and open_[-1] < len(x) / 4


# --- resampling ---------------------------------------------------------------


def words_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def features_of(text, longest):
    words = words_of(text)
    return [" ".join(words[i : i + k]) for k in range(1, longest + 1) for i in range(len(words) - k + 1)]


def brute_resample(rows, target, percent, least_words, longest, buckets, seed):
    def bucket(f):
        return zlib.crc32(f.encode()) % buckets

    s = collections.Counter(bucket(f) for _, x in rows for f in features_of(x, longest))
    t = collections.Counter(bucket(f) for x in target for f in features_of(x, longest))
    total_s, total_t = s.total(), t.total()
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + buckets) / ((s[b] + 1) * (total_t + buckets)))) for b in range(buckets)]
    out = []
    for key, text in rows:
        own = features_of(text, longest)
        weight = sum(gain[bucket(f)] for f in own)
        h = int(hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()[:8], 16)
        out.append((key, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(words_of(text))))
    able = sorted((r for r in out if r[4] >= least_words), key=lambda r: (-r[3], r[0] is not None, r[0] or 0, r[1]))
    drawn = percent * len(able) // 100
    ranks = [(r[:4], i + 1 if i < drawn else None) for i, r in enumerate(able)] + [(r[:4], None) for r in out if r[4] < least_words]
    return collections.Counter((*r, rank) for r, rank in ranks)


def test_odd_texts_are_resampled(spark):
    rng = np.random.default_rng(3)
    vocabulary = [f"w{i}" for i in range(60)] + ["ß", "Straße", "x-y", "Ärger"]
    rows = [(int(i), " ".join(rng.choice(vocabulary, rng.integers(1, 60)))) for i in range(400)]
    rows += ODD + [(-5, rows[3][1]), (1 << 62, rows[4][1]), (-(1 << 62), rows[5][1]), (9, None), (3, rows[3][1]), (3, rows[3][1])]
    target = ["w1 w2 w3 Strasse", None, "", "W1 w4 ÄRGER ärger"]
    df = spark.createDataFrame(rows, DOCS).repartition(5).withColumn("WEIGHT", F.lit("x")).withColumn("place", F.lit(1))
    goal = spark.createDataFrame([(x,) for x in target], "text string")
    for percent, longest in ((10, 1), (100, 2)):
        p = {"percent": percent, "least_words": 20, "longest": longest, "buckets": 500, "seed": 2024}
        got = collections.Counter(map(tuple, resampling.resample(df, goal, **p).collect()))
        assert got == brute_resample(rows, target, **p)


def test_empty_tables_are_resampled(spark):
    df = spark.createDataFrame([(1, "a b " * 20), (1, "a b " * 20)], DOCS)
    none = df.where("false")
    assert resampling.resample(none, df.select("text")).collect() == []
    got = sorted(r["rank"] for r in resampling.resample(df, none.select("text"), percent=100).collect())
    assert got == [1, 2]


def test_radix_ranks_by_small_digits_and_blocks(spark):
    rng = np.random.default_rng(8)
    a, b = rng.integers(-5, 5, 3000).tolist(), rng.integers(-(1 << 62), 1 << 62, 3000).tolist()
    b[10:400] = [7] * 390
    a[20:400] = [1] * 380
    rows = written(spark.createDataFrame(list(zip(a, b, strict=True)), "a bigint, b bigint").repartition(6), "rows")
    got = sorted(resampling.radix_ranks(rows, ["a", "b"], digit_bits=9, block_bits=7).collect(), key=lambda r: r["place"])
    assert [r["place"] for r in got] == list(range(3000))
    assert [(r["a"], r["b"]) for r in got] == sorted(zip(a, b, strict=True))


# --- near duplicates ----------------------------------------------------------


def shingles_of(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if len(words) < 4:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 4]) for i in range(len(words) - 3)}


def brute_groups(rows):
    sets = [shingles_of(t) for _, t in rows]
    lists = collections.defaultdict(list)
    for i, s in enumerate(sets):
        for x in s:
            lists[x].append(i)
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    pairs = collections.Counter()
    for i, s in enumerate(sets):
        for j, n in collections.Counter(j for x in s for j in lists[x] if j < i).items():
            pairs[i, j] = n
    for (i, j), n in pairs.items():
        if 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
            root[find(i)] = find(j)
    ids = collections.defaultdict(list)
    for i, (key, _) in enumerate(rows):
        ids[find(i)].append(key)
    out = collections.Counter()
    for i, (key, _) in enumerate(rows):
        least = min((k for k in ids[find(i)] if k is not None), default=None)
        out[key, len(sets[i]), least, key == least] += 1
    return out


def near_groups(df):
    return collections.Counter(map(tuple, bottomk.groups(df).collect()))


def edited(rng, words, n):
    words = list(words)
    for i in rng.integers(0, len(words), n):
        words[i] = f"e{rng.integers(0, 1 << 40)}"
    return words


def test_odd_texts_and_thresholds(spark):
    rng = np.random.default_rng(4)
    rows = list(ODD)
    key = 100
    for length in (8, 40, 200, 600, 1500, 6000):
        for copy in range(12):
            base = [f"v{x}" for x in rng.integers(0, 900, length)]
            for n in (0, 0, 1, length // 50 + 1, length // 36, length // 20, length // 10):
                rows.append((key, " ".join(edited(rng, base, n))))
                key += 1
            rows.append((key, " ".join(base[: int(length * 0.82)])))
            rows.append((key, " ".join(base[: int(length * 0.78)])))
            key += 1
    df = spark.createDataFrame(rows, DOCS).repartition(7).withColumn("NODE", F.lit("x")).withColumn("size", F.lit(1))
    assert near_groups(df) == brute_groups(rows)
    assert near_groups(df.where("false")) == {}


def test_large_lists(spark, monkeypatch):
    """A large group of near copies, chains among them, and unlike texts round one passage."""
    rng = np.random.default_rng(9)
    base = [f"b{x}" for x in range(120)]
    passage = [f"p{x}" for x in range(90)]
    rows = [(i, " ".join(edited(rng, base, int(rng.integers(0, 5))))) for i in range(400)]
    rows += [(1000 + i, " ".join(passage + [f"q{x}" for x in rng.integers(0, 1 << 40, int(rng.integers(4, 40)))])) for i in range(300)]
    chain = [f"c{x}" for x in range(200)]
    rows += [(2000 + i, " ".join(chain[i : i + 60])) for i in range(0, 140, 3)]
    want = brute_groups(rows)
    df = spark.createDataFrame(rows, DOCS).repartition(4)
    for large in (32, 3):
        monkeypatch.setattr(bottomk, "LARGE_LIST", large)
        assert near_groups(df) == want


def test_sketch_estimate_and_needs():
    rng = np.random.default_rng(6)
    common = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    a, b = (np.unique(np.concatenate([common, rng.integers(0, 1 << 63, 500).astype(np.uint64)])) for _ in range(2))
    both, n = bottomk.estimate(a[: bottomk.K], b[: bottomk.K])
    assert n == bottomk.K and abs(both / n - 0.8) < 0.08
    # The chance that a link's union sketch shares less than SHARED, by Chernoff's bound.
    t = bottomk.SHARED / bottomk.K
    assert bottomk.K * (t * math.log(t / 0.8) + (1 - t) * math.log((1 - t) / 0.2)) > math.log(10**12)


def test_components_of_chains_and_stars(spark):
    rng = np.random.default_rng(1)
    order = rng.permutation(400).tolist()
    links = [(order[i], order[i + 1]) for i in range(200)] + [(order[300], order[i]) for i in range(301, 380)]
    got = dict(map(tuple, stars.components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    chain, star = order[:201], order[300:380]
    assert got == {**{i: min(chain) for i in chain}, **{i: min(star) for i in star}}
    assert stars.components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_registered():
    assert {"op11_centroid_clustering", "op12_resampling", "op13_near_duplicates"} <= set(queries.QUERIES) & set(queries.ORACLE)
