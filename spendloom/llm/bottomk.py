"""Near duplicates by bottom-k sketches: inverted lists, union-sketch estimates, exact Jaccard.

Words are what stands between spaces and tabs to carriage returns, A-Z lower-cased; a row's shingles are its distinct runs
of four words (of fewer words, all of them as one).  Rows link when 100 * overlap >= 80 * union.

1. One hash function orders all shingles; a set's sketch is its ``K`` least hashes, for a smaller set all of it.  Equal
   sets are one node.
2. Sets that link share at least ``needed(size)`` retained values: for sets within K that is exact; beyond it fewer than
   ``SHARED`` of K values of the union's sketch are shared with a chance below 10^-12 (Chernoff).  So a node is listed
   under its rarest retained values only, more than it may miss, and nodes that link still meet in lists.
3. Inverted lists of few nodes give their pairs with overlap counts; a pair stays if these and the large lists that both
   are in can reach what it needs.  In large lists every node is paired with one leader a round; what links join needs no
   more comparing.  Pairs of large lists that are still apart after the rounds are then all taken, each once.
4. The union's sketch (the K least of two sketches) estimates the Jaccard index and filters; sets within K are decided
   there, as their sketches are whole; the others are compared as full sets.
5. Links become components; a row's component is the least id in it.

Defined results: null and empty texts, and ones of white space, have no shingles and link with nothing.  Rows of one id are
rows of their own; a component's id is its least id that isn't null (none: null), and of a null id's row ``kept`` says
whether all of its component's ids are null.  Ties don't arise: links are symmetric.  Other columns don't matter.  Nodes
and shingles have 64-bit hashes: two different sets of 10^9 are taken for equal with a chance of 3 %.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, merged, pick, written
from spendloom.llm.stars import components

SHINGLE = 4
PERCENT = 80
K = 512
SHARED = 336
#: Sets of ``LONG`` shingles or more are listed under so many values more, which pairs must then share as well.
LONG, MORE = 400, 24
#: Counters of retained values, by which rare ones are told from frequent ones.
SLOTS = 1 << 20
#: Lists of more nodes are large.
LARGE_LIST = 8
#: Turns of leaders before all pairs that are still apart are taken.
LEADER_ROUNDS = 2
BATCH_BYTES = 1 << 20
GROUP_BYTES = 1 << 19
BLOOM_BITS = 1 << 26
#: Shingles of a block of nodes, whose pairs are compared together.
BLOCK = 1 << 16

FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
_PLACES = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)
_WORDS = np.uint64(0xA0761D6478BD642F)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _words(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Where the words between spaces begin in ``data`` (which ends with eight spaces), and their hashes."""
    gap = np.frombuffer(data, np.uint8) == 32
    edges = np.flatnonzero(gap[1:] != gap[:-1]) + 1
    edges = np.append(0, edges) if not gap[0] else edges
    starts, ends = edges[::2], edges[1::2]
    eight = np.ndarray(len(data) - 7, "<u8", data, strides=(1,))
    left = ends - starts
    hashes = left.astype(np.uint64) * _WORDS
    at, rows = starts, np.arange(len(starts))
    while len(rows):
        part = eight[at]
        short = left < 8
        part[short] &= (np.uint64(1) << (8 * left[short]).astype(np.uint64)) - np.uint64(1)
        hashes[rows] = _mixed(hashes[rows] ^ part)
        more = left > 8
        rows, at, left = rows[more], at[more] + 8, left[more] - 8
    return starts, hashes


def _sets(texts: list[bytes | None]) -> list[np.ndarray]:
    folded = [(t or b"").translate(FOLD) for t in texts]
    starts, words = _words(b" ".join([*folded, b" " * 8]))
    cuts = np.searchsorted(starts, np.cumsum([0, *(len(t) + 1 for t in folded)])).tolist()
    runs = max(len(words) - SHINGLE + 1, 0)
    hashes = np.zeros(runs, np.uint64)
    for i in range(SHINGLE):
        hashes += words[i : i + runs] * _PLACES[i]
    hashes = _mixed(hashes)
    out = []
    for at, end in itertools.pairwise(cuts):
        n = end - at
        if n >= SHINGLE:
            own = np.sort(hashes[at : end - SHINGLE + 1])
            new = own[1:] != own[:-1]
            out.append(own if new.all() else own[np.append(True, new)])
        elif n:
            out.append(_mixed((words[at:end] * _PLACES[:n]).sum(keepdims=True) + np.uint64(n) * _WORDS))
        else:
            out.append(hashes[:0])
    return out


def shingle_sets(texts: list[bytes | None]) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    out, held, size = [], [], 0
    for text in texts:
        held.append(text)
        size += len(text or b"")
        if size >= GROUP_BYTES:
            out += _sets(held)
            held, size = [], 0
    return out + _sets(held) if held else out


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def needed(size: int) -> int:
    """How many retained values a set shares at least with any set that it links with."""
    return min(-(-size * PERCENT // 100), SHARED)


def listed(size: int) -> int:
    """Under how many values a set is listed."""
    return min(size, K) - needed(size) + 1 + (MORE if size >= LONG else 0)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Of the union's sketch, made from two sketches: how many values both sets have, and its length."""
    union = np.union1d(a, b)[:K]
    both = np.intersect1d(a, b, assume_unique=True)
    return int((both <= union[-1]).sum()), len(union)


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _texts(batch: pa.RecordBatch) -> list[bytes | None]:
    return batch.column("text").cast(pa.binary()).to_pylist()


def sketched(docs: DataFrame) -> tuple[DataFrame, np.ndarray]:
    """``doc_id, node, size`` of each row (written), and how often retained values fall in each slot."""
    names = ["doc_id", "node", "size", "slot", "n"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, counts = set(), np.zeros(SLOTS, np.int64)
        for batch in merged(batches, BATCH_BYTES):
            sets = shingle_sets(_texts(batch))
            ids = [node_of(s) for s in sets]
            for node, shingles in zip(ids, sets, strict=True):
                if node not in seen:
                    np.add.at(counts, (shingles[:K] & np.uint64(SLOTS - 1)).astype(np.int64), 1)
                    if len(seen) < 1 << 18:
                        seen.add(node)
            none = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())
            size = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_signed(ids)), size, *none], names)
        # Slots that stand out; which values count as rare among the others makes little difference.
        mean = counts.mean()
        slot = np.flatnonzero(counts >= 4 + mean + 6 * np.sqrt(mean)).astype(np.int32)
        none = [pa.nulls(len(slot), pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*none, pa.array(slot), pa.array(counts[slot])], names)

    kinds = "doc_id bigint, node bigint, size bigint, slot int, n bigint"
    rows = written(map_batches(pick(docs, "doc_id", "text"), work, kinds), "sketched")
    often = np.zeros(SLOTS, np.int32)
    found = rows.where("slot IS NOT NULL").groupBy("slot").agg(F.least(F.sum("n"), F.lit((1 << 31) - 1)).alias("n"))
    found = found.toArrow()  # at most one row for each slot
    often[found.column("slot").to_numpy()] = found.column("n").to_numpy()
    return rows.where("slot IS NULL").select("doc_id", "node", "size"), often


def inverted(docs: DataFrame, often: np.ndarray) -> DataFrame:
    """``value, node, size, members`` of lists with two nodes or more (written): each node under its rarest values."""
    shared = docs.sparkSession.sparkContext.broadcast(often)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order, seen = shared.value, set()
        for batch in merged(batches, BATCH_BYTES):
            values, ids, sizes = [], [], []
            for shingles in shingle_sets(_texts(batch)):
                node = node_of(shingles)
                if not len(shingles) or node in seen:
                    continue
                if len(seen) < 1 << 18:
                    seen.add(node)
                sketch = shingles[:K]
                count = order[(sketch & np.uint64(SLOTS - 1)).astype(np.int64)]
                values.append(sketch[np.argsort(count, kind="stable")[: listed(len(shingles))]])
                ids.append(node)
                sizes.append(len(shingles))
            if values:
                n = list(map(len, values))
                columns = [np.concatenate(values), np.repeat(np.array(ids, np.uint64), n), np.repeat(sizes, n)]
                columns = [pa.array(_signed(columns[0])), pa.array(_signed(columns[1])), pa.array(columns[2].astype(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["value", "node", "size"])

    entries = written(map_batches(pick(docs, "text"), work, "value bigint, node bigint, size bigint"), "entries")
    return written(_with_members(entries), "inverted")


def _with_members(entries: DataFrame) -> DataFrame:
    """Entries of lists with two nodes or more, with the list's length; entries are shuffled once, as most are alone."""
    own = Window.partitionBy("value")
    ends = {"low": F.min("node").over(own), "high": F.max("node").over(own), "members": F.count("*").over(own)}
    return entries.withColumns(ends).where("low != high").select("value", "node", "size", "members").distinct()


#: SQL for a pair: sizes near enough; retained values that a set has outside the lists; shared ones that are asked for.
_FITS = f"100 * least(x.size, y.size) >= {PERCENT} * greatest(x.size, y.size)"
_UNLISTED = f"least(({{0}} * {PERCENT} + 99) div 100, {SHARED}) - 1 - if({{0}} >= {LONG}, {MORE}, 0)"
_ASKED = f"if(greatest(size_a, size_b) <= {K}, ({PERCENT} * (size_a + size_b) + {99 + PERCENT}) div {100 + PERCENT}, {SHARED})"
#: What the overlap in the lists must reach.
_LEAST = f"greatest({_ASKED} - greatest({_UNLISTED.format('size_a')}, {_UNLISTED.format('size_b')}), 1)"
#: No more than the overlap that any partner in an entry's list asks for: what is asked rises with the partner's size up to K,
#: and what is unlisted rises but for the step at LONG.
_SHORTEST = f"greatest(shortest, (size * {PERCENT} + 99) div 100)"
_LONGEST = f"least(longest, size * 100 div {PERCENT})"
_ASKED_AT = [_ASKED.replace("size_a", "size").replace("size_b", f"({x})") for x in (_SHORTEST, _LONGEST)]
_BELOW_LONG = f"if({_SHORTEST} < {LONG} AND {_LONGEST} >= {LONG}, {needed(LONG - 1) - 1}, 0)"
_UNLISTED_AT = [_UNLISTED.format("size"), _UNLISTED.format(f"({_LONGEST})"), _BELOW_LONG]
_LEAST_OF_LIST = f"least({', '.join(_ASKED_AT)}) - greatest({', '.join(_UNLISTED_AT)})"
_PAIR = ["a", "b", "size_a", "size_b"]


def _pair() -> list[Column]:
    """x and y with the lesser node first."""
    swap = F.col("x.node") > F.col("y.node")
    choose = lambda p, q, c: F.when(swap, F.col(f"{q}.{c}")).otherwise(F.col(f"{p}.{c}"))
    return [choose(p, q, c).alias(n) for n, p, q, c in zip(_PAIR, "xyxy", "yxyx", ("node", "node", "size", "size"), strict=True)]


def _small_pairs(met: DataFrame) -> DataFrame:
    """Pairs that meet in a list of few nodes, if their overlap may reach what they need."""
    small = met.where(F.col("members") <= LARGE_LIST).select("value", F.struct("node", "size", "in_large").alias("x"))
    return (
        small.join(small.select("value", F.col("x").alias("y")), "value")
        .where(f"x.node < y.node AND {_FITS}")
        .select(*_pair(), F.least("x.in_large", "y.in_large").alias("more"))
        .groupBy(*_PAIR, "more")
        .agg(F.count("*").alias("overlap"))
        .where(f"overlap + more >= {_LEAST}")
        .select(*_PAIR)
    )


def _led_pairs(large: DataFrame, turn: int) -> DataFrame:
    """Each node of a torn list with the list's leader, the node of the least hash, if that is in another component.

    Pairs that also meet in a list of few nodes have been compared before, so the large lists alone must do.
    """
    order = F.xxhash64("node", F.lit(turn))
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    leaders = large.groupBy("value").agg(F.min_by(F.struct("node", "size", "component", "in_large"), order).alias("y"), *ends)
    return (
        large.select("value", F.struct("node", "size", "component", "in_large").alias("x"))
        .join(leaders.where("low != high").select("value", "y"), "value")
        .where(f"x.component != y.component AND {_FITS}")
        .select(*_pair(), F.least("x.in_large", "y.in_large").alias("most"))
        .where(f"most >= {_LEAST}")
        .select(*_PAIR)
        .distinct()
    )


def _apart_pairs(large: DataFrame) -> DataFrame:
    """All pairs of torn large lists that are in different components and share enough large lists, each made once.

    Nodes of different components share torn lists alone.  A node's lists are in order of their length, and a pair is made
    in the first list that it shares, so that list and those after it must do: the long ones, at the end, make few pairs,
    and an entry with too few lists after it for any size of its list is left out.
    Near copies share most of their lists.  What rules them out is asked in order of its cost, and without lambdas, which
    Spark interprets.
    """
    ends = [F.min("component").alias("low"), F.max("component").alias("high"), F.count("*").alias("members")]
    ends += [F.min("size").alias("shortest"), F.max("size").alias("longest")]
    torn = large.join(large.groupBy("value").agg(*ends).where("low != high").drop("low", "high"), "value")
    ordered = F.sort_array(F.collect_list(F.struct("members", "value"))).getField("value")
    lists = torn.groupBy("node").agg(ordered.alias("values"))
    at = F.array_position("values", F.col("value")).cast("int")
    parts = [
        (F.size("values") - at + 1).alias("left"),
        F.get("values", at - 2).alias("previous"),
        F.slice("values", F.lit(1), at - 1).alias("before"),
        F.slice("values", at, F.size("values")).alias("rest"),
    ]
    rows = torn.join(lists, "node").where(F.size("values") - at + 1 >= F.expr(_LEAST_OF_LIST))
    rows = rows.select("value", F.struct("node", "size", "component", *parts).alias("x"))
    least = _LEAST.replace("size_a", "x.size").replace("size_b", "y.size")
    return (
        rows.join(rows.select("value", F.col("x").alias("y")), "value")
        .where(f"x.node < y.node AND x.component != y.component AND {_FITS}")
        .where(f"least(x.left, y.left) >= {least} AND coalesce(x.previous != y.previous, true)")
        .where("NOT arrays_overlap(x.before, y.before)")
        .where(f"size(array_intersect(x.rest, y.rest)) >= {least}")
        .select(*_pair())
    )


def _bits(ids: np.ndarray) -> list[np.ndarray]:
    return [(ids >> np.uint64(s) & np.uint64(BLOOM_BITS - 1)).astype(np.int64) for s in (0, 19, 38)]


def _bloom(wanted: DataFrame) -> np.ndarray:
    """Bits of the nodes: a filter of fixed size that lets through all of them and some others."""
    at = [F.expr(f"shiftrightunsigned(node, {s}) & {BLOOM_BITS - 1}") for s in (0, 19, 38)]
    words = (
        wanted.select(F.explode(F.array(*at)).alias("at"))
        .groupBy(F.expr("at div 32").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
        .toArrow()  # at most one row for each word of the filter
    )
    table = np.zeros(BLOOM_BITS // 32, np.uint32)
    table[words.column("word").to_numpy()] = words.column("bits").to_numpy().astype(np.uint32)
    return table


def _may_have(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which nodes the filter lets through."""
    maybe = np.ones(len(ids), bool)
    for at in _bits(ids):
        maybe &= (table[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
    return maybe


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


class Sets:
    """``node, packed``: whole sets of the nodes asked for, ascending, so that a sketch is where a set begins."""

    def __init__(self, docs: DataFrame):
        self.docs, self.have, self.found = pick(docs, "text"), None, None

    def of(self, pairs: DataFrame) -> DataFrame:
        """Reads the texts once more for the pairs' nodes that aren't there yet."""
        first = self.have is None
        wanted = _nodes_of(pairs).distinct()
        new = written(wanted if self.have is None else wanted.join(self.have, "node", "left_anti"), "wanted")
        if self.have is None or not new.isEmpty():
            once = map_batches(self.docs, self._reader(_bloom(new)), "node bigint, packed binary").join(new, "node")
            found = written(once.groupBy("node").agg(F.first("packed").alias("packed")), "sets")
            self.have = new if self.have is None else self.have.union(new)
            self.found = found if self.found is None else self.found.union(found)
        return self.found if first else among(self.found, pairs)

    def _reader(self, bits: np.ndarray):
        shared = self.docs.sparkSession.sparkContext.broadcast(bits)

        def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            table, seen = shared.value, set()
            for batch in merged(batches, BATCH_BYTES):
                own = {node_of(s): s for s in shingle_sets(_texts(batch)) if len(s)}
                ids = np.array([i for i in own if i not in seen], np.uint64)
                ids = ids[_may_have(table, ids)]
                if len(seen) < 1 << 18:
                    seen.update(ids.tolist())
                packed = pa.array([own[i].tobytes() for i in ids.tolist()], pa.binary())
                yield pa.RecordBatch.from_arrays([pa.array(_signed(ids)), packed], ["node", "packed"])

        return work


def among(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Sets of the pairs' nodes and of few others: a set that no pair needs isn't shuffled to them."""
    shared = sets.sparkSession.sparkContext.broadcast(_bloom(_nodes_of(pairs).distinct()))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("node").to_numpy().view(np.uint64)
            yield batch.filter(pa.array(_may_have(shared.value, ids)))

    return map_batches(sets, work, sets.schema)


def _with_sets(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    one, two = (sets.select(F.col("node").alias(n), F.col("packed").alias(f"p{n}")) for n in "ab")
    return pairs.join(one, "a").join(two, "b")


def _arrays(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    for x, y in zip(batch.column("pa").to_pylist(), batch.column("pb").to_pylist(), strict=True):
        yield np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)


def _estimated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose union sketch has enough shared values; ``linked`` where whole sketches decide."""
    for batch in batches:
        small = np.maximum(batch.column("size_a").to_numpy(), batch.column("size_b").to_numpy()) <= K
        keep, linked = np.zeros(len(small), bool), np.zeros(len(small), bool)
        for i, (a, b) in enumerate(_arrays(batch)):
            if small[i]:
                both = len(np.intersect1d(a, b, assume_unique=True))
                keep[i] = linked[i] = 100 * both >= PERCENT * (len(a) + len(b) - both)
            else:
                both, n = estimate(a, b)
                keep[i] = both * K >= SHARED * n
        kept = pa.array(keep)
        columns = [batch.column("a").filter(kept), batch.column("b").filter(kept), pa.array(linked[keep])]
        yield pa.RecordBatch.from_arrays(columns, ["a", "b", "linked"])


def _confirmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [(len(np.intersect1d(a, b, assume_unique=True)), len(a) + len(b)) for a, b in _arrays(batch)]
        links = pa.array([100 * o >= PERCENT * (n - o) for o, n in both], pa.bool_())
        yield pa.RecordBatch.from_arrays([batch.column(n).filter(links) for n in "ab"], ["a", "b"])


def _link(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two whole sets link; of large ones the union's sketch is asked first."""
    if max(len(a), len(b)) > K:
        both, n = estimate(a[:K], b[:K])
        if both * K < SHARED * n:
            return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link: ``a, b`` (written)."""
    sketches = sets.select("node", F.substring("packed", 1, 8 * K).alias("packed"))
    columns = ["a", "b", "size_a", "size_b", "pa", "pb"]
    likely = written(
        map_batches(_with_sets(pairs, sketches).select(columns), _estimated, "a bigint, b bigint, linked boolean"), "likely"
    )
    open_ = likely.where("NOT linked").select("a", "b")
    full = _with_sets(open_, among(sets, open_)).select("a", "b", "pa", "pb")
    return written(likely.where("linked").select("a", "b").union(map_batches(full, _confirmed, "a bigint, b bigint")), "links")


def blocked(pairs: DataFrame) -> DataFrame:
    """``a, b, block_a, block_b``: pairs, and blocks of nodes that go with one node, at most ``BLOCK`` shingles on average.

    A node goes with the least hash of those that it is paired with and its own, so that a group of near copies, in which
    most are paired with most, comes into few blocks, of a size that doesn't grow with the group.
    """
    near = pairs.select(F.col("a").alias("node"), F.col("size_a").alias("size"), F.col("b").alias("other"))
    near = near.union(pairs.select("b", "size_b", "a"))
    hashed = F.least(F.min(F.xxhash64("other")), F.xxhash64("node"))
    home = near.groupBy("node", "size").agg(hashed.alias("home"))
    parts = home.groupBy("home").agg(F.expr(f"cast(sum(size) div {BLOCK} + 1 as bigint)").alias("parts"))
    part = F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts"))
    blocks = written(home.join(parts, "home").select("node", F.xxhash64("home", part).alias("block")), "blocks")
    one, two = (blocks.select(F.col("node").alias(n), F.col("block").alias(f"block_{n}")) for n in "ab")
    return pairs.select("a", "b").join(one, "a").join(two, "b")


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows by meeting, each meeting's sets before its pairs: the pairs that link."""
    at, sets = None, {}
    for batch in batches:
        out = []
        columns = (batch.column(n) for n in ("meeting", "a", "b", "packed"))
        for meeting, a, b, packed in zip(*(c.to_pylist() for c in columns), strict=True):
            if meeting != at:
                at, sets = meeting, {}
            if packed is not None:
                sets[a] = np.frombuffer(packed, np.uint64)
            elif _link(sets[a], sets[b]):
                out.append((a, b))
        yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in (zip(*out) if out else ((), ()))], ["a", "b"])


def verified_in_blocks(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """As ``verified``, for many pairs of few nodes: whole sets go to each two blocks that have pairs, not to each pair."""
    pairs = blocked(pairs)
    pairs = pairs.select(F.xxhash64(F.least("block_a", "block_b"), F.greatest("block_a", "block_b")).alias("meeting"), "a", "b")
    pairs = written(pairs, "meetings")
    ends = pairs.select("meeting", F.col("a").alias("node")).union(pairs.select("meeting", "b")).distinct()
    met = ends.join(sets, "node").select("meeting", F.col("node").alias("a"), F.lit(None).cast("bigint").alias("b"), "packed")
    rows = met.union(pairs.withColumn("packed", F.lit(None).cast("binary")))
    rows = rows.repartition("meeting").sortWithinPartitions("meeting", F.col("packed").isNull())
    return written(map_batches(rows, _compared, "a bigint, b bigint"), "links")


def linked_nodes(docs: DataFrame, met: DataFrame) -> DataFrame:
    """``node, component`` of the nodes that links touch (written)."""
    is_large = F.col("members") > LARGE_LIST
    met = met.join(met.groupBy("node").agg(F.sum(is_large.cast("int")).alias("in_large")), "node")
    met = written(met, "met")
    large = met.where(is_large).select("value", "node", "size", "in_large")
    some = not large.isEmpty()
    pairs = _small_pairs(met)
    if some:
        pairs = pairs.union(_led_pairs(large.withColumn("component", F.col("node")), 0)).distinct()
    pairs = written(pairs, "pairs")
    sets = Sets(docs)
    links = verified(pairs, sets.of(pairs))
    reached = written(components(links), "reached")
    for turn in range(1, LEADER_ROUNDS + 1 if some else 1):
        own = large.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
        own = written(own, "large")
        pairs = _apart_pairs(own) if turn == LEADER_ROUNDS else _led_pairs(own, turn)
        pairs = written(pairs, "pairs")
        if pairs.isEmpty():
            continue
        check = verified_in_blocks if turn == LEADER_ROUNDS else verified
        found = check(pairs, sets.of(pairs))
        # Nodes that are joined already stand for their components.
        links = reached.select(F.col("node").alias("a"), F.col("component").alias("b")).union(found)
        reached = written(components(links), "reached")
    return reached


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs`` (columns doc_id, text)."""
    rows, often = sketched(docs)
    reached = linked_nodes(docs, inverted(docs, often))
    full = rows.where("size > 0")
    least = full.groupBy("node").agg(F.min("doc_id").alias("least"))
    named = least.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = named.join(ids, "component").select("node", "component_id")
    some = full.join(by_node, "node").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    none = rows.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return some.union(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
