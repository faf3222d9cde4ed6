"""Benchmark decontamination: an FM-index per shard of the corpus, searched backward for the benchmark's phrases.

Words are ``[0-9a-z]`` and everything beyond ASCII, after lower-casing A-Z.  A phrase is a window of ``WINDOW``
consecutive words of an item; a shorter item with words is one phrase.  A shard is a run of documents of about
``SHARD_BYTES``.  Its words become numbers: a word that no phrase has, and the end of each document, is a barrier that
no phrase crosses (neighbouring barriers become one).  Barriers are distinct to the suffix sorting, so suffixes differ
soon even where documents are copies.  The index holds the Burrows-Wheeler transform in a wavelet matrix, whose ranks
drive the backward search of all phrases at once, and every ``SAMPLE``-th suffix position, from which occurrences are
located by walking back.  Occurrences become spans of hit words, merged where they overlap or touch.

The benchmark is the stated query set.  It is collected in blocks of at most ``BLOCK_CHARS`` code points; a benchmark
of one block (the usual case) takes one pass over the corpus, a larger one a pass per block over rows numbered first.

Null and empty texts have no words and no hits; an empty benchmark hits nothing; items that repeat a phrase all count;
rows that repeat are each answered.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.llm.common import fresh, map_batches, merged, pick, schema_with, written

WINDOW = 10
SHARD_BYTES = 4 << 20
SAMPLE = 8
BLOCK_CHARS = 2 << 20
BARRIER = 1

#: Bytes that are part of words; the others, and only they, become spaces.
FOLD = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")


def words_of(text: bytes) -> list[bytes]:
    return text.translate(FOLD).split()


class Phrases:
    """The windows of a block of items, as numbers."""

    def __init__(self, items: list[tuple], window: int = WINDOW):
        self.ids: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[int]] = {}
        self.item_ids = [str(k) for k, _ in items]
        for at, (_, text) in enumerate(items):
            words = [self.ids.setdefault(w, len(self.ids) + 2) for w in words_of((text or "").encode())]
            for i in range(max(1, len(words) - window + 1) if words else 0):
                seen.setdefault(tuple(words[i : i + window]), set()).add(at)
        self.length = np.array([len(w) for w in seen], np.int64)
        self.words = np.zeros((len(seen), window), np.int64)
        for i, w in enumerate(seen):
            self.words[i, window - len(w) :] = w  # right-aligned: the search runs from the last word
        self.owners = [sorted(s) for s in seen.values()]
        self.sigma = len(self.ids) + 2


class FMIndex:
    def __init__(self, symbols: np.ndarray, sigma: int, sample: int = SAMPLE):
        """symbols: numbers >= 2, or BARRIER; the last one is a BARRIER."""
        n = len(symbols)
        barrier = symbols == BARRIER
        order = _suffixes(symbols, barrier)
        bwt = symbols[order - 1]  # before the first comes the last, a barrier
        self.bwt = bwt
        counts = np.bincount(symbols, minlength=sigma)
        self.first = np.concatenate([[0], np.cumsum(counts)])  # rows before those that begin with a symbol
        # Sampled are each SAMPLE-th position and those after a barrier, so that no walk has to cross one.
        marked = (order % sample == 0) | (bwt == BARRIER)
        self.marks = np.concatenate([[0], np.cumsum(marked)])
        self.marked = marked
        self.samples = order[marked]
        self.levels = []
        bits = max(1, int(sigma - 1).bit_length())
        row = bwt
        for level in range(bits - 1, -1, -1):
            bit = (row >> level & 1).astype(bool)
            ones = np.zeros(n + 1, np.int32)
            np.cumsum(bit, out=ones[1:])
            zeros = n - int(ones[-1])
            self.levels.append((level, ones, zeros))
            row = np.concatenate([row[~bit], row[bit]])

    def rank(self, symbol: np.ndarray, *ends: np.ndarray) -> list[np.ndarray]:
        """How often each symbol stands in the transform before each of ``ends``."""
        at = np.stack([np.zeros_like(ends[0]), *ends])
        for level, ones, zeros in self.levels:
            one = ones[at]
            at = np.where((symbol >> level & 1).astype(bool), zeros + one, at - one)
        return [x - at[0] for x in at[1:]]

    def search(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray]:
        """Phrase and row for each occurrence, by backward search of all phrases side by side."""
        width = phrases.words.shape[1]
        live = np.arange(len(phrases.words))
        low = np.zeros(len(live), np.int64)
        high = np.full(len(live), len(self.bwt), np.int64)
        done = []
        for step in range(width):
            symbol = phrases.words[live, width - 1 - step]
            a, b = self.rank(symbol, low, high)
            low, high = self.first[symbol] + a, self.first[symbol] + b
            full = (phrases.length[live] == step + 1) & (low < high)
            done.append((live[full], low[full], high[full]))
            keep = (phrases.length[live] > step + 1) & (low < high)
            live, low, high = live[keep], low[keep], high[keep]
            if not live.size:
                break
        phrase, low, high = (np.concatenate(x) for x in zip(*done, strict=True))
        n = high - low
        rows = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)
        return np.repeat(phrase, n), rows

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows: walk back to a sampled position."""
        at, steps, out = rows.copy(), np.zeros(len(rows), np.int64), np.zeros(len(rows), np.int64)
        live = np.arange(len(rows))
        while live.size:
            hit = self.marked[at[live]]
            found = live[hit]
            out[found] = self.samples[self.marks[at[found]]] + steps[found]
            live = live[~hit]
            if live.size:
                symbol = self.bwt[at[live]]
                at[live] = self.first[symbol] + self.rank(symbol, at[live])[0]
                steps[live] += 1
        return out


def _suffixes(symbols: np.ndarray, barrier: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling; each barrier is a symbol of its own, lower than words, in text order.

    So many suffixes are unlike after a few words; only those still alike are sorted again.
    """
    n = len(symbols)
    walls = int(barrier.sum())
    rank = symbols + walls
    rank[barrier] = np.arange(walls)
    top = int(rank.max()) + 1
    second = np.zeros(n, np.int64)
    second[:-1] = rank[1:]
    key = rank * top + second
    order = np.argsort(key)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    depth = 2
    while True:
        heads = np.flatnonzero(new)
        rank[order] = np.repeat(heads, np.diff(np.append(heads, n)))
        loose = ~new
        loose[:-1] |= loose[1:]
        at = np.flatnonzero(loose)  # places of suffixes that are like a neighbour so far
        if not at.size:
            return order
        suffix = order[at]
        follow = suffix + depth
        # A suffix that is like another ends before no barrier, so depth words follow it within the text.
        key = rank[suffix] * n + rank[follow]
        inner = np.argsort(key)
        order[at] = suffix[inner]
        key = key[inner]
        new[at] = np.concatenate([[True], key[1:] != key[:-1]])
        depth *= 2


class Shard:
    """Occurrences of the phrases in a run of texts, as word numbers over the whole run."""

    def __init__(self, texts: list[bytes | None], phrases: Phrases):
        get, parts, sizes = phrases.ids.get, [], []
        for text in texts:
            words = words_of(text) if text else []
            sizes.append(len(words))
            parts.append(np.fromiter(map(get, words, repeat(BARRIER)), np.int64, len(words)))
            parts.append(np.array([BARRIER]))
        self.sizes = np.array(sizes, np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        symbols = np.concatenate(parts)
        position = np.arange(len(symbols)) - np.repeat(np.arange(len(sizes)), self.sizes + 1)
        keep = np.ones(len(symbols), bool)
        keep[1:] = (symbols[1:] != BARRIER) | (symbols[:-1] != BARRIER)
        symbols, position = symbols[keep], position[keep]
        self.phrase = self.at = np.zeros(0, np.int64)
        if len(phrases.words) and len(symbols) > 1:
            index = FMIndex(symbols, phrases.sigma)
            self.phrase, rows = index.search(phrases)
            self.at = position[index.locate(rows)]
        self.length = phrases.length[self.phrase]
        self.document = np.searchsorted(self.starts + self.sizes, self.at, side="right")
        cover = np.zeros(int(self.sizes.sum()) + 1, np.int64)
        np.add.at(cover, self.at, 1)
        np.add.at(cover, self.at + self.length, -1)
        self.hit = np.cumsum(cover[:-1]) > 0

    def spans(self) -> list[list[tuple[int, int]]]:
        """Merged runs of hit words of each document, as word numbers in it, end exclusive."""
        out: list[list[tuple[int, int]]] = [[] for _ in self.sizes]
        for i in np.unique(self.document).tolist():
            hit = self.hit[self.starts[i] : self.starts[i] + self.sizes[i]].astype(np.int8)
            edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
            out[i] = list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))
        return out


def _places(text: bytes, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Spans of words as byte offsets."""
    found = [m.span() for m in WORD.finditer(text)]
    return [(found[a][0], found[b - 1][1]) for a, b in spans]


def _scanned(texts: pa.Array, phrases: Phrases) -> list[pa.Array]:
    raw = texts.cast(pa.binary()).to_pylist()
    shard = Shard(raw, phrases)
    spans = shard.spans()
    items: list[set[int]] = [set() for _ in raw]
    for code in np.unique(shard.document * max(1, len(phrases.length)) + shard.phrase).tolist():
        document, phrase = divmod(code, len(phrases.length))
        items[document].update(phrases.owners[phrase])
    places = [
        [(len(t[:a].decode()), len(t[:b].decode())) for a, b in _places(t, s)] if s else []
        for t, s in zip(raw, spans, strict=True)
    ]
    return [
        pa.array(shard.sizes),
        pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
        pa.array([sorted(phrases.item_ids[i] for i in s) for s in items], pa.list_(pa.string())),
        pa.array([[a for a, _ in p] for p in places], pa.list_(pa.int64())),
        pa.array([[b for _, b in p] for p in places], pa.list_(pa.int64())),
        pa.array([[a for a, _ in s] for s in spans], pa.list_(pa.int64())),
        pa.array([[b for _, b in s] for s in spans], pa.list_(pa.int64())),
    ]


_FOUND = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("items", T.ArrayType(T.StringType())),
    T.StructField("starts", T.ArrayType(T.LongType())),
    T.StructField("ends", T.ArrayType(T.LongType())),
    T.StructField("word_starts", T.ArrayType(T.LongType())),
    T.StructField("word_ends", T.ArrayType(T.LongType())),
]
FIELDS = [f.name for f in _FOUND]


def _blocks(items: DataFrame, block_chars: int) -> Iterator[list[tuple]]:
    block, size = [], 0
    for row in items.toLocalIterator():
        block.append((row[0], row[1]))
        size += len(row[1] or "")
        if size >= block_chars:
            yield block
            block, size = [], 0
    if block or not size:
        yield block


def _scan(df: DataFrame, text: str, names: dict[str, str], block: list[tuple], window: int) -> DataFrame:
    """All of df's columns and what this block's phrases hit."""
    phrases = df.sparkSession.sparkContext.broadcast(Phrases(block, window))
    at = df.columns.index(text)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches, SHARD_BYTES):
            yield pa.RecordBatch.from_arrays([*batch.columns, *_scanned(batch.column(at), phrases.value)], out)

    schema = schema_with(df, *[T.StructField(names[f.name], f.dataType) for f in _FOUND])
    out = schema.fieldNames()
    return map_batches(df, work, schema)


def leaks(
    docs: DataFrame,
    items: DataFrame,
    text: str = "text",
    names: dict[str, str] | None = None,
    window: int = WINDOW,
    block_chars: int = BLOCK_CHARS,
) -> DataFrame:
    """``docs`` with what the benchmark ``items`` (item_id, text) hit in it.

    Added columns, renamed by ``names``: n_words, n_hit, items (ids, sorted), starts and ends (code points of the
    merged spans), word_starts and word_ends (the same spans in words).
    """
    names = {f: f for f in FIELDS} | (names or {})
    blocks = _blocks(pick(items, "item_id", "text"), block_chars)
    first = next(blocks)
    second = next(blocks, None)
    if second is None:
        return _scan(docs, text, names, first, window)
    row = fresh(docs, "row")
    kept = written(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    plain = {f: f for f in FIELDS}
    part = kept.select(F.col(row).alias("row"), F.col(f"`{text}`").alias("text"))
    found = None
    for block in (first, second, *blocks):
        one = written(_scan(part, "text", plain, block, window).drop("text"), "hits")
        found = one if found is None else found.unionByName(one)
    # Spans of all blocks: a start opens, an end closes; they merge where the depth stays above 0 or they touch.
    def unite(a: str, b: str):
        spans = F.array_sort(F.flatten(F.collect_list(F.arrays_zip(F.col(a).alias("a"), F.col(b).alias("b")))))
        start = F.array().cast("array<struct<a:bigint,b:bigint>>")

        def step(acc, x):
            last = F.element_at(acc, -1)
            joined = F.concat(
                F.slice(acc, 1, F.size(acc) - 1),
                F.array(F.struct(last["a"].alias("a"), F.greatest(last["b"], x["b"]).alias("b"))),
            )
            apart = F.concat(acc, F.array(F.struct(x["a"].alias("a"), x["b"].alias("b"))))
            return F.when((F.size(acc) > 0) & (x["a"] <= last["b"]), joined).otherwise(apart)

        return F.aggregate(spans, start, step)

    total = (
        found.groupBy("row")
        .agg(
            F.max("n_words").alias("n_words"),
            F.array_sort(F.flatten(F.collect_list("items"))).alias("items"),
            unite("starts", "ends").alias("chars"),
            unite("word_starts", "word_ends").alias("words"),
        )
        .select(
            F.col("row"),
            F.col("n_words").alias(names["n_words"]),
            F.aggregate("words", F.lit(0).cast("bigint"), lambda acc, x: acc + x["b"] - x["a"]).alias(names["n_hit"]),
            F.col("items").alias(names["items"]),
            F.transform("chars", lambda x: x["a"]).alias(names["starts"]),
            F.transform("chars", lambda x: x["b"]).alias(names["ends"]),
            F.transform("words", lambda x: x["a"]).alias(names["word_starts"]),
            F.transform("words", lambda x: x["b"]).alias(names["word_ends"]),
        )
        .withColumnRenamed("row", row)
    )
    return kept.join(total, row).drop(row)


def remove_leaks(docs: DataFrame, items: DataFrame, window: int = WINDOW) -> DataFrame:
    """The documents without the benchmark's passages; ``n_chars`` follows.  All rows and columns stay."""
    names = {f: fresh(docs, f"leak_{f}") for f in FIELDS}
    found = leaks(docs, items, names=names, window=window)
    starts, ends = F.col(names["starts"]), F.col(names["ends"])
    # Pieces between spans, by offsets: 0, ends... and starts..., the text's length.
    begin = F.concat(F.array(F.lit(0).cast("bigint")), ends)
    finish = F.concat(starts, F.array(F.length("text").cast("bigint")))
    pieces = F.transform(
        F.arrays_zip(begin.alias("a"), finish.alias("b")),
        lambda x: F.substring(F.col("text"), x["a"].cast("int") + 1, (x["b"] - x["a"]).cast("int")),
    )
    clean = F.when(F.size(starts) > 0, F.array_join(pieces, "\n")).otherwise(F.col("text"))
    changed = found.withColumn("text", clean)
    if "n_chars" in docs.columns:
        changed = changed.withColumn("n_chars", F.when(F.size(starts) > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return changed.select(*[F.col(f"`{c}`") for c in docs.columns])
