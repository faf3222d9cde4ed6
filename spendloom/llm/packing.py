"""Best-fit packing by linear grouping: documents as token sequences into as few training sequences as possible.

Texts become ids of the byte-level vocabulary, followed by an end id.  With ``added`` the added tokens of
``byte_bpe_50k.json`` are matched inside texts, as its tokenizer does; without, they are spelled like any text.
A document longer than a sequence is cut into
pieces, the first of which may be shorter; no other document is cut.

Pieces of one length are alike, so the plan is made from the count of each length (1024 numbers), whatever the size
of the corpus.  Large pieces, by falling length, go into groups of equal cardinality whose lengths round up to the
group's largest.  For these few sizes a linear program over configurations (which sizes share a sequence) is
solved by column generation.  Its rounded-down solution is filled with actual pieces, rank by rank, and the space
their true lengths leave is filled with the small pieces and the remaining ones, longest first, each where it fits
best.  The plan is a list of runs: so many pieces of one length, from this rank on, go to consecutive sequences at one
offset.  Ranks of pieces are counted by task and length while they are written, and added up by Spark.

Null and empty texts are one piece that holds the end id.  Repeated rows are packed each.  An empty table gives no
pieces.
"""

from __future__ import annotations

import base64
import json
import zlib
from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, pick, written

SEQUENCE = 1024
END = 2
#: From which share of a sequence a piece is large, and into how many groups those go; the plan with the fewest
#: sequences is taken.
GROUPINGS = ((1 / 2, 64), (2 / 5, 64), (1 / 3, 32))


@lru_cache(maxsize=2)
def encoder(ranks_path: str | None = None, added: bool = False):
    """Text to ids of the byte-level vocabulary, as ``byte_bpe_50k.json`` gives them, several times as fast."""
    import public_tokenizers
    import tiktoken

    with open(ranks_path or public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    special = {}
    if added:
        with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f:
            special = {t["content"]: t["id"] for t in json.load(f)["added_tokens"]}
    found = tiktoken.Encoding("byte_bpe_50k", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
    return partial(found.encode_to_numpy, allowed_special="all", disallowed_special=())


def cuts(n: int, sequence: int = SEQUENCE) -> list[tuple[int, int]]:
    """Start and length of each piece of a document of n ids."""
    first = n % sequence or sequence
    bounds = [0, *range(first, n + 1, sequence)]
    return [(a, b - a) for a, b in zip(bounds, bounds[1:], strict=False)]


def pieces(
    docs: DataFrame, keep_ids: bool = True, sequence: int = SEQUENCE, ranks_path: str | None = None, added: bool = False
) -> DataFrame:
    """Every piece of every document, ranked among the pieces of its length in its task (written).

    ``doc_id, piece, start, length, ids_crc32, ids, task, rank``; ids are packed little-endian 32-bit numbers, or null.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, task = encoder(ranks_path, added), TaskContext.get().partitionId()
        ranks = np.zeros(sequence + 1, np.int64)
        names = ["doc_id", "piece", "start", "length", "ids_crc32", "ids", "task", "rank"]
        for batch in batches:
            rows = []
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = np.append(encode(text) if text else np.zeros(0, np.uint32), END).astype("<u4")
                for i, (start, length) in enumerate(cuts(len(ids), sequence)):
                    packed = ids[start : start + length].tobytes()
                    rows.append((key, i, start, length, zlib.crc32(packed), packed if keep_ids else None, task, ranks[length]))
                    ranks[length] += 1
            if rows:
                kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.int64()]
                columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, task int, rank bigint"
    return written(map_batches(pick(docs, "doc_id", "text"), work, schema), "pieces")


def _knapsack(sizes: list[int], value: np.ndarray, room: int) -> tuple[float, np.ndarray]:
    """The multiset of sizes within ``room`` of the greatest value."""
    size = np.array(sizes)
    best, last = np.zeros(room + 1), np.full(room + 1, -1)
    for w in range(min(sizes), room + 1):
        gain = np.where(size <= w, best[w - size] + value, -1.0)  # a negative place is not used
        k = int(gain.argmax())
        best[w], last[w] = best[w - 1], -1
        if gain[k] > best[w] + 1e-12:
            best[w], last[w] = gain[k], k
    chosen, w = np.zeros(len(sizes)), room
    while w > 0:
        if last[w] < 0:
            w -= 1
        else:
            chosen[last[w]] += 1
            w -= sizes[last[w]]
    return float(best[room]), chosen


def configurations(sizes: list[int], demand: np.ndarray, room: int = SEQUENCE) -> list[tuple[np.ndarray, int]]:
    """How often to use which configuration: the linear program's optimum, rounded down."""
    k = len(sizes)
    basis = np.diag([float(room // s) for s in sizes])
    amount = demand / np.diag(basis)
    for _ in range(10 * k):
        inverse = np.linalg.inv(basis)
        price = np.ones(k) @ inverse
        value, column = _knapsack(sizes, price, room)
        if value <= 1 + 1e-7:
            break
        direction = inverse @ column
        ratio = np.where(direction > 1e-9, amount / np.where(direction > 1e-9, direction, 1), np.inf)
        out = int(ratio.argmin())
        amount = amount - ratio[out] * direction
        amount[out] = ratio[out]
        basis[:, out] = column
    return [(basis[:, j].astype(int), int(amount[j] + 1e-6)) for j in range(k)]


class Plan:
    """Runs: pieces of a length with ranks from ``rank`` on go to sequences from ``sequence`` on, at ``offset``."""

    def __init__(self, counts: dict[int, int], room: int, large: float, groups: int):
        self.room, self.sequences = room, 0
        self.runs: list[tuple[int, int, int, int]] = []  # length, rank, sequence, offset
        self.free: list[list[tuple[int, int]]] = [[] for _ in range(room + 1)]  # by room left: first sequence, how many
        rest = self._large({n: c for n, c in counts.items() if n >= room * large}, groups)
        rest += [(n, 0, c) for n, c in counts.items() if n < room * large and c]
        self._best_fit(sorted(rest, reverse=True))
        runs = np.array(sorted(self.runs), np.int64).reshape(-1, 4)
        self.keys, self.first, self.offset = (runs[:, 0] << 44) + runs[:, 1], runs[:, 2], runs[:, 3]
        del self.runs, self.free

    @classmethod
    def best(cls, counts: dict[int, int], room: int = SEQUENCE) -> Plan:
        return min((cls(counts, room, *g) for g in GROUPINGS), key=lambda plan: plan.sequences)

    def _large(self, counts: dict[int, int], groups: int) -> list[tuple[int, int, int]]:
        """Fills configurations; what is left: length, first rank, how many."""
        total = sum(counts.values())
        if not total:
            return []
        each = -(-total // groups)
        members: list[list[tuple[int, int, int]]] = [[]]  # of a group: length, first rank, how many
        room = each
        for n in sorted(counts, reverse=True):
            rank = 0
            while rank < counts[n]:
                if not room:
                    members.append([])
                    room = each
                take = min(room, counts[n] - rank)
                members[-1].append((n, rank, take))
                rank, room = rank + take, room - take
        sizes = [m[0][0] for m in members]
        plan = configurations(sizes, np.array([float(sum(x[2] for x in m)) for m in members]), self.room)
        for configuration, times in plan:
            slots = [k for k, a in enumerate(configuration) for _ in range(a)]
            filled = [self._take(members[k], times) for k in slots]
            times = min((sum(x[2] for x in f) for f in filled), default=0) if times else 0
            self._fill(filled, times)
            for k, f in zip(slots, filled, strict=True):  # a group that ran out gives back what its partners hold
                self._give_back(members[k], f, times)
        return [x for m in members for x in m]

    @staticmethod
    def _take(members: list[tuple[int, int, int]], n: int) -> list[tuple[int, int, int]]:
        out = []
        while n and members:
            length, rank, many = members.pop(0)
            take = min(n, many)
            out.append((length, rank, take))
            if take < many:
                members.insert(0, (length, rank + take, many - take))
            n -= take
        return out

    @staticmethod
    def _give_back(members: list, taken: list, used: int) -> None:
        back = []
        for length, rank, many in taken:
            keep = min(used, many)
            used -= keep
            if keep < many:
                back.append((length, rank + keep, many - keep))
        members[:0] = back

    def _fill(self, slots: list[list[tuple[int, int, int]]], times: int) -> None:
        """``times`` sequences with the pieces of each slot side by side, as runs of sequences of the same lengths."""
        done, at = 0, [(0, 0)] * len(slots)  # of each slot: which part, how far in it
        while done < times:
            step = min([times - done, *(s[i][2] - used for s, (i, used) in zip(slots, at, strict=True))])
            offset = 0
            for k, s in enumerate(slots):
                i, used = at[k]
                length, rank, many = s[i]
                self.runs.append((length, rank + used, self.sequences, offset))
                offset += length
                at[k] = (i + 1, 0) if used + step == many else (i, used + step)
            self.free[self.room - offset].append((self.sequences, step))
            self.sequences += step
            done += step

    def _best_fit(self, rest: list[tuple[int, int, int]]) -> None:
        for length, rank, many in rest:
            while many:
                left = next((r for r in range(length, self.room + 1) if self.free[r]), None)
                if left is None:
                    new = -(-many // (self.room // length))
                    self.free[self.room].append((self.sequences, new))
                    self.sequences += new
                    continue
                first, n = self.free[left].pop()
                take = min(n, many)
                if take < n:
                    self.free[left].append((first + take, n - take))
                self.runs.append((length, rank, first, self.room - left))
                self.free[left - length].append((first, take))
                rank, many = rank + take, many - take

    def places(self, length: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of pieces."""
        key = (length << 44) + rank
        at = np.searchsorted(self.keys, key, side="right") - 1
        return self.first[at] + key - self.keys[at], self.offset[at]


def pack(
    docs: DataFrame, keep_ids: bool = True, sequence: int = SEQUENCE, ranks_path: str | None = None, added: bool = False
) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset`` for every piece."""
    spark = docs.sparkSession
    cut = pieces(docs, keep_ids, sequence, ranks_path, added)
    counted = cut.groupBy("task", "length").count()
    # One row for each length.
    counts = {r["length"]: r["n"] for r in counted.groupBy("length").agg(F.sum("count").alias("n")).collect()}
    plan = spark.sparkContext.broadcast(Plan.best(counts, sequence))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    base = counted.select("task", "length", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base"))
    ranked = cut.join(base, ["task", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "ids", (F.col("rank") + F.col("base")).alias("rank")
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, offset = plan.value.places(batch.column("length").to_numpy(), batch.column("rank").to_numpy())
            yield pa.RecordBatch.from_arrays([*batch.columns[:6], pa.array(at), pa.array(offset)], names)

    schema = "doc_id bigint, piece int, start bigint, length bigint, ids_crc32 bigint, ids binary, sequence_id bigint, offset bigint"
    names = [f.split()[0] for f in schema.split(", ")]
    return map_batches(ranked, work, schema)
