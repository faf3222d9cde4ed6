"""N-gram Jaccard join: the documents-by-shingles incidence matrix times its transpose, in blocks of columns.

Lower-cased (A-Z) words are what stands between spaces and tabs to carriage returns; a row's shingles are its distinct
runs of five words (of fewer words, all of them as one).  Two rows link when 100 * overlap >= 75 * union.

1. Every text becomes a set of 64-bit shingle hashes; equal sets are one node.  Columns (shingles) are counted in a
   table of ``SLOTS`` counters, so that frequent columns are known.
2. Size bound: rows of s shingles that link share at least ceil(.75 s) of them, so they meet in one of the first
   s - ceil(.75 s) + 1 columns of any common order.  That order is: rare columns first.  Only these entries are kept,
   and dealt out by column in packed blocks; a block's product yields the columns where two nodes or more meet.
3. Pairs of a meeting are first those of each node with a few leaders: links that these give connect most groups of
   copies, and nodes that links connect need no more comparing, so a large group costs in proportion to its size.
   Then all pairs that are still apart are taken.  No bound on partners, nothing is sampled.
   Overlap counts accumulate over the kept columns; as a row has at most ceil(.75 s) - 1 other columns, a pair whose
   count falls short of the overlap that its sizes ask for is discarded.  The rest is compared on whole sets.
   A node is thick if it has meetings for a good part of its columns.  Where many thick nodes meet they are not paired at
   all: they lie in blocks, and for each two blocks that meet, the product of their whole rows tells all links at once.  So
   the pairs of a large group of copies are never rows of a table.
4. Links become components by alternating large and small stars.

Null and empty texts have no shingles and link with nothing.  Rows of one id keep apart as rows; the component's id is
the smallest id in it (nulls don't count).  Node digests have 64 bits: two different sets of 10^9 are taken for equal
with a chance of 3 %.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.llm.common import fresh, map_batches, merged, pick, schema_with, written
from spendloom.llm.stars import components

SHINGLE = 5
SLOTS = 1 << 20
BATCH_BYTES = 1 << 20
#: Texts that are hashed at once.
GROUP_BYTES = 1 << 19
#: Packed entries a task gathers before it hands them on, and entries a block of columns should have.
FLUSH_BYTES = 8 << 20
BLOCK_BYTES = 16 << 20
#: Meetings of more nodes are large.
LARGE_MEETING = 64
#: How many nodes of a large meeting lead it, about, beside the one of the least hash.
LEADERS = 6
#: Packed shingles of pairs that are compared at once.
PIECE_BYTES = 1 << 20
#: Nodes that meet others in one of so many shingles, or more, are thick.
THICK = 20
#: Shingles that a block of thick nodes has, about.
BLOCK_SHINGLES = 1 << 19
#: Columns of a product that are dense at once, and entries of a column from which on it is.
DENSE, HEAVY = 1 << 11, 8
#: How often at most other leaders are tried while that connects nodes.
STAR_ROUNDS = 4
BLOOM_BITS = 1 << 26

FOLD = bytes(b + 32 if 65 <= b <= 90 else 32 if 9 <= b <= 13 else b for b in range(256))
ENTRY = np.dtype([("column", "<u8"), ("node", "<u8"), ("size", "<u4")])

_BASE = np.uint64(0x9E3779B97F4A7C15)
_UNBASE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base)
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class Hasher:
    """Shingle hashes of many texts at once: differences of prefix sums of a polynomial over the joined words."""

    def __init__(self):
        self.up = self.down = np.zeros(0, np.uint64)

    def _spans(self, data: bytes, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        if len(self.up) <= len(data):
            n = max(len(data) + 1, GROUP_BYTES * 3 // 2)
            self.up, self.down = _powers(_BASE, n), _powers(_UNBASE, n)
        terms = np.frombuffer(data, np.uint8).astype(np.uint64)
        terms += np.uint64(1)
        terms *= self.up[: len(terms)]
        sums = np.zeros(len(terms) + 1, np.uint64)
        np.cumsum(terms, out=sums[1:])
        return _mixed((sums[ends] - sums[starts]) * self.down[starts])

    def sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        out, held, size = [], [], 0
        for text in texts:
            held.append(text)
            size += len(text or b"")
            if size >= GROUP_BYTES:
                out += self._sets(held)
                held, size = [], 0
        return out + self._sets(held) if held else out

    def _sets(self, texts: list[bytes | None]) -> list[np.ndarray]:
        folded = [b" ".join(t.translate(FOLD).split()) if t else b"" for t in texts]
        data = b" ".join(folded) + b" "
        sizes = np.fromiter(map(len, folded), np.int64, len(folded))
        begins = np.cumsum(sizes + 1) - sizes - 1
        gaps = np.flatnonzero(np.frombuffer(data, np.uint8) == 32)  # one after each word, or one for an empty text
        out: list[np.ndarray] = []
        at = np.searchsorted(gaps, begins)
        last = np.searchsorted(gaps, begins + sizes) + 1
        words = np.where(sizes > 0, last - at, 0)
        n = np.where(words > 0, np.maximum(words - SHINGLE + 1, 1), 0)
        owner = np.repeat(np.arange(len(texts)), n)
        first = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + at[owner]
        # A word starts after the gap before it; a text's first word starts where the text does.
        start = np.where(first == at[owner], begins[owner], gaps[np.maximum(first - 1, 0)] + 1)
        end = gaps[np.minimum(first + SHINGLE - 1, last[owner] - 1)]
        hashes = self._spans(data, start, end)
        cuts = np.cumsum(n) - n
        for a, k in zip(cuts.tolist(), n.tolist(), strict=True):
            own = np.sort(hashes[a : a + k])
            out.append(own[np.append(True, own[1:] != own[:-1])] if k > 1 else own)
        return out


def node_of(shingles: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(shingles.tobytes())


def prefix_length(size: int) -> int:
    return size - (3 * size + 3) // 4 + 1


def _signed(x) -> np.ndarray:
    return np.asarray(x, np.uint64).view(np.int64)


def _raw(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(name).cast(pa.binary()).to_pylist()


def nodes(docs: DataFrame) -> tuple[DataFrame, np.ndarray, int]:
    """``doc_id, node, size`` of each row (written), how often columns are hit by slot, and the number of entries."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, seen, counts = Hasher(), set(), np.zeros(SLOTS, np.int64)
        names = ["doc_id", "node", "size", "slot", "n"]
        for batch in merged(batches, BATCH_BYTES):
            sets = hasher.sets(_raw(batch))
            ids = [node_of(s) for s in sets]
            new = []
            for node, shingles in zip(ids, sets, strict=True):
                if node not in seen:
                    new.append(shingles)
                    if len(seen) < 1 << 18:
                        seen.add(node)
            if new:
                counts += np.bincount((np.concatenate(new) & np.uint64(SLOTS - 1)).astype(np.int64), minlength=SLOTS)
            none = pa.nulls(len(ids), pa.int32()), pa.nulls(len(ids), pa.int64())
            size = pa.array([len(s) for s in sets], pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_signed(ids)), size, *none], names)
        total = int(counts.sum())
        mean = total / SLOTS
        slots = np.flatnonzero(counts >= 8 + mean + 8 * np.sqrt(mean))
        slot = np.append(slots, -1).astype(np.int32)
        none = [pa.nulls(len(slot), pa.int64())] * 3
        yield pa.RecordBatch.from_arrays([*none, pa.array(slot), pa.array(np.append(counts[slots], total))], names)

    rows = map_batches(pick(docs, "doc_id", "text"), work, "doc_id bigint, node bigint, size bigint, slot int, n bigint")
    kept = written(rows, "nodes")
    frequent = np.zeros(SLOTS, np.int64)
    total = 0
    # At most one row for each slot.
    for slot, n in kept.where("slot IS NOT NULL").groupBy("slot").agg(F.sum("n")).collect():
        if slot < 0:
            total = n
        else:
            frequent[slot] = n
    return kept.where("slot IS NULL").select("doc_id", "node", "size"), frequent, total


def _entries(docs: DataFrame, frequent: np.ndarray, blocks: int) -> DataFrame:
    """``block, packed``: the entries within the size bound, dealt out by column."""
    table = docs.sparkSession.sparkContext.broadcast(frequent.astype(np.int32))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, order = Hasher(), table.value
        held: list[np.ndarray] = []
        size, seen = 0, set()

        def flush() -> pa.RecordBatch:
            entries = np.concatenate(held)
            block = ((entries["column"] >> np.uint64(32)) % np.uint64(blocks)).astype(np.int64)
            by = np.argsort(block, kind="stable")
            entries, block = entries[by], block[by]
            heads = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
            parts = [entries[a:b].tobytes() for a, b in zip(heads, np.append(heads[1:], len(block)), strict=True)]
            return pa.RecordBatch.from_arrays(
                [pa.array(block[heads].astype(np.int32)), pa.array(parts, pa.binary())], ["block", "packed"]
            )

        for batch in merged(batches, BATCH_BYTES):
            for shingles in hasher.sets(_raw(batch)):
                node = node_of(shingles)
                if not len(shingles) or node in seen:
                    continue
                seen.add(node)
                count = order[(shingles & np.uint64(SLOTS - 1)).astype(np.int64)]
                k = prefix_length(len(shingles))
                chosen = shingles[np.argsort(count, kind="stable")[:k]] if count.any() else shingles[:k]
                rows = np.empty(len(chosen), ENTRY)
                rows["column"], rows["node"], rows["size"] = chosen, node, len(shingles)
                held.append(rows)
                size += rows.nbytes
            if size >= FLUSH_BYTES:
                yield flush()
                held, size, seen = [], 0, set()
        if held:
            yield flush()

    return map_batches(pick(docs, "text"), work, "block int, packed binary")


def _meetings(entries: np.ndarray) -> pa.RecordBatch:
    """Columns of a block that two nodes or more have; equal sets of nodes once.  ``meeting, node, size, columns``."""
    entries = entries[np.lexsort((entries["node"], entries["column"]))]
    new = np.append(True, (entries["column"][1:] != entries["column"][:-1]) | (entries["node"][1:] != entries["node"][:-1]))
    entries = entries[new]
    heads = np.flatnonzero(np.append(True, entries["column"][1:] != entries["column"][:-1]))
    n = np.diff(np.append(heads, len(entries)))
    shared = np.repeat(n > 1, n)
    entries, n = entries[shared], n[n > 1]
    heads = np.cumsum(n) - n
    if not len(n):
        return _meeting_rows(entries, np.zeros(0, np.uint64))
    # Size bound: a node stays if a node next to it by size is near enough.
    column = np.repeat(np.arange(len(n)), n)
    by = np.lexsort((entries["size"], column))
    size, own = entries["size"][by].astype(np.int64), column[by]
    near = np.append((own[1:] == own[:-1]) & (4 * size[:-1] >= 3 * size[1:]), False)
    stays = np.zeros(len(entries), bool)
    stays[by] = near | np.append(False, near[:-1])
    entries, column = entries[stays], column[stays]
    if not len(entries):
        return _meeting_rows(entries, np.zeros(0, np.uint64))
    heads = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
    n = np.diff(np.append(heads, len(column)))
    name = np.add.reduceat(_mixed(entries["node"] * _BASE + np.uint64(1)), heads)  # depends on the set of nodes alone
    _, first, columns = np.unique(name, return_index=True, return_counts=True)
    once = np.zeros(len(n), np.int64)
    once[first] = columns
    kept = once > 0
    weight = np.repeat(once[kept], n[kept])
    return _meeting_rows(entries[np.repeat(kept, n)], np.repeat(name[kept], n[kept]), weight)


def _meeting_rows(entries: np.ndarray, name: np.ndarray, columns: np.ndarray | None = None) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            pa.array(_signed(name)),
            pa.array(_signed(np.ascontiguousarray(entries["node"]))),
            pa.array(entries["size"].astype(np.int64)),
            pa.array(np.zeros(0, np.int64) if columns is None else columns),
        ],
        ["meeting", "node", "size", "columns"],
    )


def meetings(docs: DataFrame, frequent: np.ndarray, total: int) -> DataFrame:
    """Sets of nodes that share columns within the size bound, and how many: ``meeting, node, size, columns`` (written)."""
    spark = docs.sparkSession
    blocks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), total // 4 * ENTRY.itemsize // BLOCK_BYTES + 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: dict[int, list[bytes]] = {}
        for batch in batches:
            for block, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own.setdefault(block, []).append(packed)
        for packed in own.values():
            yield _meetings(np.frombuffer(b"".join(packed), ENTRY))

    dealt = _entries(docs, frequent, blocks).repartitionById(blocks, F.col("block"))
    found = map_batches(dealt, work, "meeting bigint, node bigint, size bigint, columns bigint")
    return written(
        found.groupBy("meeting", "node").agg(F.max("size").alias("size"), F.sum("columns").alias("columns")), "meetings"
    )


def _enough() -> Column:
    """Whether the overlap in the kept columns lets a pair reach the overlap that its sizes ask for."""
    asked = F.expr("(3 * (size_a + size_b) + 6) div 7")
    rest = F.expr("(3 * greatest(size_a, size_b) + 3) div 4 - 1")
    return F.col("columns") >= asked - rest


def _pair(a: str, b: str) -> list[Column]:
    """a and b with the lesser node first."""
    swap = F.col(f"{a}.node") > F.col(f"{b}.node")
    pick_ = lambda x, y, c: F.when(swap, F.col(f"{y}.{c}")).otherwise(F.col(f"{x}.{c}"))
    return [
        pick_(a, b, "node").alias("a"),
        pick_(b, a, "node").alias("b"),
        pick_(a, b, "size").alias("size_a"),
        pick_(b, a, "size").alias("size_b"),
    ]


#: SQL: size bound of the pair (x, y), and whether the columns that each shares with anyone leave it possible.
_FITS = "4 * least(x.size, y.size) >= 3 * greatest(x.size, y.size)"
_ASKED = "(3 * (x.size + y.size) + 6) div 7 - ((3 * greatest(x.size, y.size) + 3) div 4 - 1)"
_POSSIBLE = f"least(x.most, y.most) >= {_ASKED}"
_NODE = ("node", "size", "most", "component")


def _led(apart: DataFrame, met: DataFrame, turn: int) -> DataFrame:
    """Each node of a meeting with the meeting's leaders from other components; overlap counts over all meetings.

    The node of the least hash leads, and ``LEADERS`` more members of a large meeting, so that pairs are in proportion to
    members.  Hashes differ from turn to turn, but not between meetings.
    """
    order = F.xxhash64("node", F.lit(turn))
    place = F.pmod(order, F.lit(1 << 30)) / float(1 << 30)
    least = apart.groupBy("meeting").agg(F.min_by(F.struct(*_NODE), order).alias("y"))
    more = apart.where((F.col("members") > LARGE_MEETING) & (place * F.col("members") < LEADERS))
    leaders = least.union(more.select("meeting", F.struct(*_NODE).alias("y")))
    found = (
        apart.select("meeting", F.struct(*_NODE).alias("x"))
        .join(leaders, "meeting")
        .where(f"x.component != y.component AND {_FITS} AND {_POSSIBLE}")
        .select(*_pair("x", "y"))
        .distinct()
    )
    one = met.select(F.col("node").alias("a"), "meeting", "columns")
    other = met.select(F.col("node").alias("b"), "meeting")
    return (
        found.join(one, "a")
        .join(other, ["meeting", "b"])
        .groupBy("a", "b", "size_a", "size_b")
        .agg(F.sum("columns").alias("columns"))
        .where(_enough())
    )


def _thick() -> Column:
    return F.expr(f"{THICK} * most >= size")


def _loose_pairs(met: DataFrame) -> DataFrame:
    """``a, b``: all pairs that may link, but those of thick nodes that share a meeting of many.

    Their overlaps are counted.  Large meetings tend to have nearly the same nodes.  So there every node carries its large meetings (the high 40 bits) with their columns (the low 24), and a pair is made in
    the least of its large meetings alone, if what it has in those and what either node has in small ones (``few``) may be
    enough.
    """
    may = f"{_FITS} AND {_POSSIBLE}"
    pairs = _pair("x", "y")
    small = met.where(F.col("members") <= LARGE_MEETING).select("meeting", "columns", F.struct(*_NODE).alias("x"))
    often = (
        small.join(small.select("meeting", F.col("x").alias("y")), "meeting")
        .where(f"x.node < y.node AND {may}")
        .select(*pairs, "columns")
    )
    code = F.expr("(meeting & ~16777215L) | least(columns, 16777215L)")
    large = met.where(F.col("members") > LARGE_MEETING)
    lists = large.groupBy("node").agg(F.collect_list(code).alias("all"), F.sum("columns").alias("in_large"))
    few = (F.col("most") - F.col("in_large")).alias("few")
    dense = _dense().alias("dense")
    listed = large.join(lists, "node").select("meeting", code.alias("here"), dense, F.struct(*_NODE, "all", few).alias("x"))
    shared = "aggregate(array_intersect(x.all, y.all), 0L, (sum, m) -> sum + (m & 16777215L))"
    once = (
        listed.where("NOT dense")
        .join(listed.select("meeting", F.col("dense").alias("other"), F.col("x").alias("y")), "meeting")
        .where(f"(other OR x.node < y.node) AND {may}")
        .where(f"array_min(array_intersect(x.all, y.all)) = here AND {shared} + least(x.few, y.few) >= {_ASKED}")
        .select(*pairs, F.expr(shared).alias("columns"))
    )
    counted = often.union(once).groupBy("a", "b", "size_a", "size_b").agg(F.sum("columns").alias("columns"))
    return counted.where(_enough()).select("a", "b")


def _dense() -> Column:
    """Whether a node is one of many thick ones of a meeting."""
    return _thick() & (F.col("thick") > LARGE_MEETING)


def _still_apart(pairs: DataFrame, reached: DataFrame | None) -> DataFrame:
    """The pairs (a, b) that are in different components."""
    if reached is None:
        return pairs
    for end in "ab":
        pairs = pairs.join(reached.toDF(end, f"of_{end}"), end, "left")
    return pairs.where("coalesce(of_a, a) != coalesce(of_b, b)").select("a", "b")


def _sides(shard: pa.Table) -> tuple[pa.Table, int]:
    """Rows of two blocks of nodes, or of one, the first block's before the others; how many are the first block's."""
    other = shard.column("block").to_numpy() != shard.column("p")[0].as_py()
    return shard.take(pa.array(np.argsort(other, kind="stable"))), int(np.count_nonzero(~other))


def _hopeful(shard: pa.Table) -> pa.Table:
    """Nodes that may link to one of the other block, or of their own if that is both, from another component.

    Columns that two nodes share are those of the meetings that they share, in ``codes``, and no more than ``few`` others.
    """
    rows, one = _sides(shard)
    first = 0 if one == rows.num_rows else one
    (sx, sy), (fx, fy), (cx, cy) = (
        (values[:one, None], values[None, first:]) for values in (rows.column(c).to_numpy() for c in ("size", "few", "component"))
    )
    lists = rows.column("codes").combine_chunks()
    row = np.repeat(np.arange(rows.num_rows), pc.list_value_length(lists).to_numpy())
    codes, at = np.unique(lists.flatten().to_numpy(), return_inverse=True)
    weight = (codes & 16777215).astype(np.float32)
    shared = np.zeros((one, rows.num_rows - first), np.float32)
    for begin in range(0, len(codes), DENSE):
        part = np.flatnonzero((at >= begin) & (at < begin + DENSE))
        dense = np.zeros((rows.num_rows, min(DENSE, len(codes) - begin)), np.float32)
        dense[row[part], at[part] - begin] = 1
        shared += (dense[:one] * weight[begin : begin + DENSE]) @ dense[first:].T
    less, more = np.minimum(sx, sy), np.maximum(sx, sy)
    asked = (3 * (sx + sy) + 6) // 7 - ((3 * more + 3) // 4 - 1)
    may = (cx != cy) & (4 * less >= 3 * more) & (shared > 0) & (shared + np.minimum(fx, fy) >= asked)
    kept = np.zeros(rows.num_rows, bool)
    kept[:one] = may.any(1)
    kept[first:] |= may.any(0)
    return rows.filter(pa.array(kept)).select(["p", "q", "block", "node", "component"])


def _product_links(shard: pa.Table) -> pa.Table:
    """Links (a, b) that connect what all links between two blocks of nodes, or within one, connect.

    Rows are sets of ``packed`` shingles; the product of the two incidence matrices has the overlap of each pair.
    """
    rows, one = _sides(shard)
    node, component = rows.column("node").to_numpy(), rows.column("component").to_numpy()
    within = one == len(node)
    codes, n = _codes(rows.column("packed").combine_chunks())
    _, column, count = np.unique(codes & np.uint64((1 << 40) - 1), return_inverse=True, return_counts=True)
    row = (codes >> np.uint64(40)).astype(np.int64)
    first = 0 if within else one
    both = np.zeros((one, len(node) - first), np.float32)
    light = np.flatnonzero((count[column] > 1) & (count[column] < HEAVY))
    light = light[np.argsort(column[light], kind="stable")]
    for far in range(1, HEAVY - 1):
        same = np.flatnonzero(column[light[far:]] == column[light[:-far]])
        x, y = row[light[same]], row[light[same + far]]  # x < y
        across = (x < one) & (y >= first)
        np.add.at(both, (x[across], y[across] - first), 1)
        if within:
            np.add.at(both, (y, x), 1)
    heavy = np.flatnonzero(count[column] >= HEAVY)
    heavy = heavy[np.argsort(column[heavy], kind="stable")]
    at = np.cumsum(np.append(0, np.diff(column[heavy]) > 0)) if len(heavy) else heavy
    for begin in range(0, int(at[-1]) + 1 if len(heavy) else 0, DENSE):
        part = slice(*np.searchsorted(at, (begin, begin + DENSE)))
        dense = np.zeros((len(node), DENSE), np.float32)
        dense[row[heavy[part]], at[part] - begin] = 1
        both += dense[:one] @ dense[first:].T
    links = 175 * both.astype(np.float64) >= 75 * (n[:one, None] + n[None, first:])
    links &= component[:one, None] != component[None, first:]
    # Labels: the least row that links reach.
    label = np.arange(len(node))
    some = links.any(0), links.any(1)
    while some[0].any():
        new = label.copy()
        new[first:] = np.minimum(new[first:], np.where(links, label[:one, None], len(node)).min(0, initial=len(node)))
        new[:one] = np.minimum(new[:one], np.where(links, new[None, first:], len(node)).min(1, initial=len(node)))
        new = new[new]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(node)))
    return pa.table({"a": node[moved], "b": node[label[moved]]})


def _dense_links(apart: DataFrame, sets: DataFrame) -> DataFrame:
    """``a, b``: links that connect thick nodes of meetings of many as far as all their links do (written).

    A node lies in a block of the largest such meeting it has and of its range of sizes.  Blocks that share such a meeting,
    and whose sizes and components let nodes link, are multiplied.
    """
    large = apart.where(_dense())
    band = F.floor(F.log("size") / F.log(F.lit(4 / 3)))
    code = F.expr("(meeting & ~16777215L) | least(columns, 16777215L)")
    own = large.groupBy("node", "size", "most", "component").agg(
        F.max_by("meeting", F.struct("thick", "meeting")).alias("home"), F.collect_list(code).alias("codes"), F.sum("columns").alias("listed")
    )
    own = own.withColumn("band", band)
    parts = own.groupBy("home", "band").agg((1 + F.expr(f"sum(size) div {BLOCK_SHINGLES}")).alias("parts"))
    block = F.xxhash64("home", "band", F.pmod(F.xxhash64("node", F.lit(1)), F.col("parts")))
    own = written(own.join(parts, ["home", "band"]).select("node", "size", "component", F.expr("most - listed AS few"), "codes", block.alias("block")), "blocks")
    ends = own.groupBy("block").agg(
        F.min("size").alias("less"), F.max("size").alias("more"), F.min("component").alias("x"), F.max("component").alias("y")
    )
    met = large.select("meeting", "node").join(own.select("node", "block"), "node").select("meeting", "block").distinct()
    two = met.withColumnRenamed("block", "p").join(met.withColumnRenamed("block", "q"), "meeting").where("p <= q")
    two = two.select("p", "q").distinct()
    for end in "pq":
        two = two.join(ends.select(F.col("block").alias(end), *[F.col(c).alias(f"{c}_{end}") for c in ("less", "more", "x", "y")]), end)
    two = two.where("4 * more_p >= 3 * less_q AND 4 * more_q >= 3 * less_p AND (x_p != y_p OR x_q != y_q OR x_p != x_q)")
    dealt = two.select("p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("block"))
    # Sets are shuffled to those pairs of blocks alone in which their nodes may link.
    hopeful = dealt.join(own, "block").select("p", "q", "block", "node", "size", "component", "few", "codes").groupBy("p", "q").applyInArrow(
        _hopeful, "p bigint, q bigint, block bigint, node bigint, component bigint"
    )
    rows = hopeful.join(sets, "node").select("p", "q", "block", "node", "component", "packed")
    return written(rows.groupBy("p", "q").applyInArrow(_product_links, "a bigint, b bigint"), "dense-links")


def _bloom_places(ids: np.ndarray) -> list[np.ndarray]:
    """Nodes are digests already: three stretches of their bits."""
    return [(ids >> np.uint64(s) & np.uint64(BLOOM_BITS - 1)).astype(np.int64) for s in (0, 19, 38)]


def _perhaps(table: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which nodes the filter lets through."""
    out = np.ones(len(ids), bool)
    for at in _bloom_places(ids):
        out &= (table[at >> 5] >> (at & 31).astype(np.uint32) & np.uint32(1)).astype(bool)
    return out


def _bloom(wanted: DataFrame) -> np.ndarray:
    """Bits of the nodes in ``wanted``: a filter of fixed size that lets through all of them and some others."""
    at = [F.expr(f"shiftrightunsigned(node, {s}) & {BLOOM_BITS - 1}") for s in (0, 19, 38)]
    words = (
        wanted.select(F.explode(F.array(*at)).alias("at"))
        .groupBy(F.expr("at div 32").alias("word"))
        .agg(F.bit_or(F.expr("shiftleft(1L, cast(at % 32 as int))")).alias("bits"))
    )
    table = np.zeros(BLOOM_BITS // 32, np.uint32)
    found = words.toArrow()  # at most one row for each word of the table
    table[found.column("word").to_numpy()] = found.column("bits").to_numpy().astype(np.uint32)
    return table


def _sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """``node, packed``: the whole sets of these nodes, 5 bytes a shingle (written); reads the texts once more."""
    wanted = written(wanted, "wanted")
    bits = docs.sparkSession.sparkContext.broadcast(_bloom(wanted))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, table = Hasher(), bits.value
        for batch in merged(batches, BATCH_BYTES):
            own = {node_of(s): s for s in hasher.sets(_raw(batch)) if len(s)}
            ids = np.fromiter(own, np.uint64, len(own))
            maybe = _perhaps(table, ids)
            packed = [_packed(own[i]) for i in ids[maybe].tolist()]
            yield pa.RecordBatch.from_arrays([pa.array(_signed(ids[maybe])), pa.array(packed, pa.binary())], ["node", "packed"])

    found = map_batches(pick(docs, "text"), work, "node bigint, packed binary")
    return written(found.join(wanted, "node").groupBy("node").agg(F.first("packed").alias("packed")), "sets")


def _packed(shingles: np.ndarray) -> bytes:
    """The low 40 bits of each: two sets of 500 have a false match in 4 million pairs."""
    low = np.sort(shingles & np.uint64((1 << 40) - 1))
    return np.ascontiguousarray(low.view(np.uint8).reshape(-1, 8)[:, :5]).tobytes()


def _codes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shingles of all rows of a batch, the row's number above them; and how many each row has."""
    raw = column.to_pylist()
    n = np.fromiter(map(len, raw), np.int64, len(raw)) // 5
    wide = np.zeros((int(n.sum()), 8), np.uint8)
    wide[:, :5] = np.frombuffer(b"".join(raw), np.uint8).reshape(-1, 5)
    return (np.repeat(np.arange(len(raw), dtype=np.uint64), n) << np.uint64(40)) + wide.view(np.uint64).ravel(), n


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in batches of few shingles, as long texts make large ones, which are slow to sort."""
    size = np.cumsum(sum(pc.binary_length(batch.column(c)).to_numpy().astype(np.int64) for c in ("pa", "pb")))
    at = np.flatnonzero(np.append(True, np.diff(size // PIECE_BYTES) > 0)) if len(size) else []
    for begin, end in zip(at, [*at[1:], batch.num_rows], strict=True):
        yield batch.slice(begin, end - begin)


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs that link, by the product of their whole rows: ``a, b`` (written)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in itertools.chain.from_iterable(map(_pieces, batches)):
            (x, n), (y, m) = _codes(batch.column("pa")), _codes(batch.column("pb"))
            both = np.bincount((x[np.isin(x, y, assume_unique=False, kind="sort")] >> np.uint64(40)).astype(np.int64), minlength=len(n))
            links = 100 * both >= 75 * (n + m - both)
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(links)) for i in range(2)], ["a", "b"])

    joined = (
        pairs.select("a", "b")
        .join(sets.select(F.col("node").alias("a"), F.col("packed").alias("pa")), "a")
        .join(sets.select(F.col("node").alias("b"), F.col("packed").alias("pb")), "b")
        .select("a", "b", "pa", "pb")
    )
    return written(map_batches(joined, work, "a bigint, b bigint"), "links")


def _nodes_of(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node")))


def link_nodes(docs: DataFrame, met: DataFrame) -> DataFrame:
    """``node, component`` of the nodes that links touch (written)."""
    none = docs.sparkSession.createDataFrame([], "a bigint, b bigint")
    met = written(met.join(met.groupBy("node").agg(F.sum("columns").alias("most")), "node"), "met")
    tested, many, reached, sets, loose, joining = none, 0, None, None, None, True
    for turn in range(STAR_ROUNDS + 1):
        own = F.col("node") if reached is None else F.coalesce("component", "node")
        here = (met if reached is None else met.join(reached, "node", "left")).withColumn("component", own)
        torn = here.groupBy("meeting").agg(
            F.min("component").alias("x"),
            F.max("component").alias("y"),
            F.count("*").alias("members"),
            F.sum(_thick().cast("int")).alias("thick"),
        ).where("x != y")
        apart = written(here.join(torn.select("meeting", "members", "thick"), "meeting"), "apart")
        last = turn == STAR_ROUNDS or not joining
        if loose is None:
            loose = written(_loose_pairs(apart), "loose-pairs")
        pairs = _still_apart(loose, reached) if last else _led(apart, met, turn)
        pairs = written(pairs.select("a", "b").join(tested, ["a", "b"], "left_anti"), "pairs")
        if sets is None:  # of all nodes that any turn asks for
            sets = _sets(docs, _nodes_of(pairs).union(_nodes_of(loose)).union(apart.where(_dense()).select("node")).distinct())
        found = _linked(pairs, sets) if (some := pairs.count()) else none
        if last:
            found = found.union(_dense_links(apart, sets))
        # Other leaders are worth a turn while they join more than a few nodes.
        joining = some > 0 and (turn == 0 and STAR_ROUNDS > 1 or found.count() * 20 > many)
        # What is joined already stands for its links.
        known = none if reached is None else reached.select(F.col("node").alias("a"), F.col("component").alias("b"))
        tested, many = tested.union(pairs), many + some
        reached = written(components(known.union(found)), "reached")
        if last:
            break
    return reached


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``doc_id, node, size`` of every row, and ``node, component`` of the nodes that links touch."""
    rows, frequent, total = nodes(docs)
    return rows, link_nodes(docs, meetings(docs, frequent, total))


def groups(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs`` (columns doc_id, text)."""
    rows, reached = _classes(docs)
    known = rows.join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    some = known.where("size > 0")
    least = some.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    full = some.join(least, "component").select("doc_id", F.col("size").alias("n_shingles"), "component_id")
    empty = known.where("size = 0").select("doc_id", F.col("size").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return full.unionByName(empty)


def representatives(docs: DataFrame) -> DataFrame:
    """One row of each group, all columns: the row of the least id (nulls last), then of the least node.

    Rows without shingles all stay.  Of rows of one id and one shingle set, the one of the least text stays.
    """
    rows, reached = _classes(docs)
    known = (
        rows.where("size > 0")
        .join(reached, "node", "left")
        .groupBy(F.coalesce("component", "node").alias("component"), "doc_id", "node")
        .agg(F.count("*").alias("n"))
    )
    order = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("node"))
    first = known.groupBy("component").agg(F.min(order).alias("first"), F.sum("n").alias("n")).where("n > 1")
    is_first = F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("node") == F.col("first.node"))
    # Rows of groups, other than the chosen ones; and chosen ones that are repeated.
    grouped = known.drop("n").join(first, "component").withColumn("chosen", is_first)
    repeated = known.where("n > 1").select("doc_id", "node")
    gone = grouped.where("NOT chosen").select("doc_id", "node", F.lit(False).alias("again"))
    again = grouped.where("chosen").join(repeated, _same("doc_id", "node", repeated, grouped), "left_semi")
    marked = gone.union(again.select("doc_id", "node", F.lit(True)))
    marked = written(marked.select(F.col("doc_id").alias("k"), F.col("node").alias("d"), "again"), "marked")

    node, again_name, key = fresh(docs, "node"), fresh(docs, "again"), fresh(docs, "gone_id")
    digest, maybe = fresh(docs, "gone_node"), fresh(docs, "maybe")
    bits = docs.sparkSession.sparkContext.broadcast(_bloom(marked.select(F.col("d").alias("node"))))
    at = docs.columns.index("text")

    def tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher()
        for batch in merged(batches, BATCH_BYTES):
            sets = hasher.sets(batch.column(at).cast(pa.binary()).to_pylist())
            full = np.array([len(s) > 0 for s in sets])
            ids = np.array([node_of(s) for s in sets], np.uint64)
            known = pa.array(_signed(ids), mask=~full)
            yield pa.RecordBatch.from_arrays([*batch.columns, known, pa.array(full & _perhaps(bits.value, ids))], names)

    schema = schema_with(docs, T.StructField(node, T.LongType()), T.StructField(maybe, T.BooleanType()))
    names = schema.fieldNames()
    marked = marked.toDF(key, digest, again_name)
    same = F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(node) == F.col(digest))
    # Rows that the filter knows not to be marked pass by, so few texts are shuffled.
    tagged = map_batches(docs, tag, schema)
    joined = tagged.where(F.col(maybe)).join(marked, same, "left")
    columns = [F.col(f"`{c}`") for c in docs.columns]
    passing = tagged.where(~F.col(maybe)).select(*columns)
    if not marked.where(F.col(again_name)).limit(1).count():
        return passing.union(joined.where(F.col(again_name).isNull()).select(*columns))
    once = Window.partitionBy("doc_id", node).orderBy("text")
    number = fresh(joined, "number")
    twice = joined.where(F.col(again_name)).withColumn(number, F.row_number().over(once)).where(F.col(number) == 1)
    return passing.union(joined.where(F.col(again_name).isNull()).select(*columns)).union(twice.select(*columns))


def _same(key: str, node: str, a: DataFrame, b: DataFrame) -> Column:
    return a[key].eqNullSafe(b[key]) & (a[node] == b[node])
