"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is the set of digests of its paragraphs (a line; a longer line is cut at sentence ends and after
``UNIT_CHARS`` code points, so that texts of one line have several cells too).  A sketch adds each digest to one cell
of each of three tables; a cell holds a count, the digests XORed and their check values XORed.  Two sketches subtract
cell by cell: what both texts have cancels out.  Peeling then takes digests from cells of one digest, again and again,
until all cells are empty; if cells remain, both sketches are built anew with twice the cells.  Each difference
recovered is exact, so the likeness (shared / all digests, Jaccard) is too.

Null and empty texts have the empty set: all cells zero, likeness 1 to each other.  A text without any paragraph
character (only punctuation) is one digest.  Rows repeated or tied by id are each kept.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spendloom.llm.common import map_batches, pick

UNIT_CHARS = 160
UNIT = re.compile(r"[^\n.!?]{1,%d}" % UNIT_CHARS)
#: Cells in each of the three tables of the fingerprint that is returned; retries double it.
CELLS = 8
TABLES = 3
GROUP_ROWS = 512

_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], dtype=np.uint64)
_CHECK = np.uint64(0xD6E8FEB86659FD93)
_S32, _S29 = np.uint64(32), np.uint64(29)


def digests(text: str) -> np.ndarray:
    """Distinct paragraph digests, sorted."""
    units = {u for part in UNIT.findall(text) if (u := part.strip())}
    if not units and text:
        units = {text}
    found = np.fromiter((xxhash.xxh3_64_intdigest(u.encode("utf-8", "surrogatepass")) for u in units), np.uint64, len(units))
    found.sort()
    return found


def _check(d: np.ndarray) -> np.ndarray:
    x = (d ^ (d >> _S29)) * _CHECK
    return x ^ (x >> _S32)


def _places(owner: np.ndarray, d: np.ndarray, cells: int) -> Iterator[np.ndarray]:
    for t in range(TABLES):
        h = d * _MIX[t]
        yield (owner * TABLES + t) * cells + ((h ^ (h >> _S32)) >> np.uint64(7) & np.uint64(cells - 1)).astype(np.int64)


class Sketches:
    """Sketches of owners 0..n-1 side by side."""

    def __init__(self, owners: int, cells: int):
        self.owners, self.cells, size = owners, cells, owners * TABLES * cells
        self.count = np.zeros(size, np.int32)
        self.key = np.zeros(size, np.uint64)
        self.check = np.zeros(size, np.uint64)

    def add(self, owner: np.ndarray, d: np.ndarray, sign) -> None:
        check = _check(d)
        for at in _places(owner, d, self.cells):
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, d)
            np.bitwise_xor.at(self.check, at, check)

    def minus(self, other: Sketches) -> Sketches:
        out = Sketches(self.owners, self.cells)
        out.count = self.count - other.count
        out.key = self.key ^ other.key
        out.check = self.check ^ other.check
        return out

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners that came out empty; then owner, digest and sign of what was found in those."""
        width, found = TABLES * self.cells, []
        while True:
            pure = np.flatnonzero((np.abs(self.count) == 1) & (_check(self.key) == self.check))
            if not pure.size:
                break
            owner, d, sign = pure // width, self.key[pure], self.count[pure]
            _, first = np.unique(d + owner.astype(np.uint64) * _MIX[0], return_index=True)
            owner, d, sign = owner[first], d[first], sign[first]
            self.add(owner, d, -sign)
            found.append((owner, d, sign))
        empty = ~((self.count != 0) | (self.key != 0)).reshape(self.owners, width).any(axis=1)
        if not found:
            none = np.zeros(0, np.int64)
            return empty, none, none.astype(np.uint64), none.astype(np.int32)
        owner, d, sign = (np.concatenate(x) for x in zip(*found, strict=True))
        good = empty[owner]
        return empty, owner[good], d[good], sign[good]

    def strings(self) -> list[str]:
        """Each owner's cells, in base64."""
        width = TABLES * self.cells
        cells = np.zeros((self.owners, width), dtype=[("count", "<i2"), ("key", "<u8"), ("check", "<u4")])
        cells["count"] = self.count.reshape(-1, width)
        cells["key"] = self.key.reshape(-1, width)
        cells["check"] = (self.check >> _S32).astype(np.uint32).reshape(-1, width)
        return [base64.b64encode(row.tobytes()).decode() for row in cells]


def _flat(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    return owner, np.concatenate(sets) if sets else np.zeros(0, np.uint64)


def sketched(sets: list[np.ndarray], cells: int = CELLS) -> Sketches:
    out = Sketches(len(sets), cells)
    out.add(*_flat(sets), 1)
    return out


def differences(old: list[np.ndarray], new: list[np.ndarray], cells: int = CELLS) -> tuple[list[list[int]], list[list[int]]]:
    """For each pair the digests only ``old`` has and those only ``new`` has, by subtracting and peeling sketches."""
    gone: list[list[int]] = [[] for _ in old]
    come: list[list[int]] = [[] for _ in old]
    pending = np.arange(len(old))
    while pending.size:
        left = sketched([old[i] for i in pending], cells).minus(sketched([new[i] for i in pending], cells))
        empty, owner, d, sign = left.peel()
        for at, digest, s in zip(pending[owner].tolist(), d.tolist(), sign.tolist(), strict=True):
            (gone if s > 0 else come)[at].append(digest)
        pending = pending[~empty]
        cells *= 2
    return gone, come


def likeness(old: list[np.ndarray], new: list[np.ndarray]) -> np.ndarray:
    """Jaccard of each pair, from the sizes and the recovered differences."""
    gone, come = differences(old, new)
    apart = np.array([len(g) + len(c) for g, c in zip(gone, come, strict=True)], float)
    both = np.array([len(a) + len(b) for a, b in zip(old, new, strict=True)], float)
    total = (both + apart) / 2
    return np.where(total > 0, (total - apart) / np.where(total > 0, total, 1), 1.0)


def version_differences(df: DataFrame, key: str, old: str, new: str) -> DataFrame:
    """Fingerprints of two versions of a text, their likeness, and the digests that only one has."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            before = [digests(t or "") for t in batch.column("old").to_pylist()]
            after = [digests(t or "") for t in batch.column("new").to_pylist()]
            gone, come = differences(before, after)
            signed = lambda rows: pa.array([np.sort(np.array(r, np.uint64)).view(np.int64) for r in rows], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("key"),
                    pa.array(sketched(before).strings(), pa.string()),
                    pa.array(sketched(after).strings(), pa.string()),
                    pa.array(likeness(before, after)),
                    signed(gone),
                    signed(come),
                ],
                ["key", "fingerprint", "new_fingerprint", "likeness", "gone", "come"],
            )

    source = pick(df, key, old, new).toDF("key", "old", "new")
    kind = source.schema["key"].dataType.simpleString()
    return map_batches(
        source,
        work,
        f"key {kind}, fingerprint string, new_fingerprint string, likeness double, gone array<bigint>, come array<bigint>",
    ).withColumnRenamed("key", key)


def _bucket(key: Column, bounds: list, low: int, high: int) -> Column:
    """How many of the falling bounds[low:high] are >= key, plus low, by halving."""
    if low == high:
        return F.lit(low)
    mid = (low + high) // 2
    return F.when(key <= F.lit(bounds[mid]), _bucket(key, bounds, mid + 1, high)).otherwise(_bucket(key, bounds, low, mid))


def in_order(docs: DataFrame) -> DataFrame:
    """``part, copy, doc_id, text`` by falling doc_id within parts, each part closed by a copy of the row after it.

    The parts' bounds are ids of the table, so the row after a part's last is known: the first of the next part, and
    for the last part the first row of all.  Null ids come last; equal ids are ordered by text.  One shuffle.
    """
    rows = pick(docs, "doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = [i / parts for i in range(1, parts)] or [0.5]
    stats = rows.agg(F.percentile_approx("doc_id", cuts, 10000).alias("cuts"), F.max("doc_id").alias("top")).first()
    bounds = sorted({c for c in stats["cuts"] or [] if c is not None and c != stats["top"]}, reverse=True)
    if stats["top"] is None:
        first = F.col("text") == F.lit(rows.agg(F.min("text")).first()[0])
    else:
        first = F.col("doc_id") == F.lit(stats["top"])
    key, last = F.col("doc_id"), len(bounds)
    part = F.when(key.isNull(), F.lit(last)).otherwise(_bucket(key, bounds, 0, last)).cast("int")
    rows = rows.withColumn("part", part)
    places = F.array_compact(
        F.array(
            F.struct("part", F.lit(0).alias("copy")),
            F.when(key.isin(bounds), F.struct((F.col("part") - 1).alias("part"), F.lit(1).alias("copy"))) if bounds else F.lit(None),
            F.when(first, F.struct(F.lit(last).alias("part"), F.lit(2).alias("copy"))),
        )
    )
    dealt = rows.select("doc_id", "text", F.explode(places).alias("p")).select("p.part", "p.copy", "doc_id", "text")
    return dealt.repartitionById(last + 1, F.col("part")).sortWithinPartitions(
        "part", "copy", F.col("doc_id").desc_nulls_last(), "text"
    )


def _edited(text: str, following: str) -> str:
    n = len(text)
    return text[: n - n // 3] + following[: n // 3]


def _compare(rows: list[tuple]) -> pa.RecordBatch:
    """rows: doc_id, text, digests, next text, next digests."""
    ids, texts, own, following, after = zip(*rows, strict=True)
    edits = [_edited(t, f) for t, f in zip(texts, following, strict=True)]
    edit_sets = [digests(e) for e in edits]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([hashlib.sha256(e.encode("utf-8", "surrogatepass")).hexdigest() for e in edits]),
            pa.array(sketched(list(own)).strings(), pa.string()),
            pa.array(sketched(edit_sets).strings(), pa.string()),
            pa.array(likeness(list(own), edit_sets)),
            pa.array(likeness(list(own), list(after))),
        ],
        ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"],
    )


def neighbour_edits(docs: DataFrame) -> DataFrame:
    """Each document against its edited text, whose last third comes from the next document, and against that document."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows = None, []
        for batch in batches:
            for part, copy, key, text in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                own = digests(text)
                if held is not None and held[0] == part and held[1] == 0:
                    rows.append((held[2], held[3], held[4], text, own))
                    if len(rows) >= GROUP_ROWS:
                        yield _compare(rows)
                        rows = []
                held = (part, copy, key, text, own)
        if rows:
            yield _compare(rows)

    schema = (
        "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double"
    )
    return map_batches(in_order(docs), work, schema)
