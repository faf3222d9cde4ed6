"""Toxicity by compression distance: how much better a toxic text's dictionary compresses a text than an ordinary one's.

Two zstandard dictionaries are trained, one on ordinary and one on toxic labelled texts.  Ordinary words are most of a
toxic text too, so the toxic dictionary is trained on the pieces that mark the class (words around character n-grams
that are far more frequent in toxic texts) and carries the ordinary dictionary as its body: the two differ only by
what toxic texts alone repeat.  Each text is cut into windows of ``WINDOW_WORDS`` words, every window is compressed with
both, and the saved bytes are compared with a ladder of thresholds.  How these shares make a score is calibrated by
logistic regression on labelled texts that the dictionaries have not seen.

The model is fitted on a bounded sample: at most ``TOXIC_TEXTS`` and ``ORDINARY_TEXTS`` labelled texts of at most
``SAMPLE_CHARS`` code points each, chosen by a hash of the id among rows that may be learned from.  Scoring reads every
text whole.

Null and empty texts are one empty window and get that score.  Repeated rows are scored alike.  Conflicting labels of
one id count as toxic.  Without toxic or ordinary labels to learn from, every score is 0.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from heapq import nsmallest

import numpy as np
import pyarrow as pa
import xxhash
import zstandard as zstd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.llm.common import learns, map_batches, merged, pick, schema_with

WINDOW_WORDS = 6
TOXIC_TEXTS = 2000
ORDINARY_TEXTS = 4000
SAMPLE_CHARS = 20000
DICTIONARY_BYTES = 8192
GRAM = 6
#: A gram marks toxic texts if it is in so many times the share of ordinary ones.
LIFT = 8.0
THRESHOLDS = np.arange(2, 8)
BATCH_BYTES = 4 << 20


def _trained(samples: list[bytes]) -> bytes:
    """Content of a dictionary trained on samples; of too few samples, the samples themselves."""
    try:
        return zstd.train_dictionary(DICTIONARY_BYTES, samples, d=6, k=24).as_bytes()
    except zstd.ZstdError:
        return b"".join(samples)[-DICTIONARY_BYTES:]


def _unlike(texts: list[str]) -> list[str]:
    """The texts without those that share a least word 4-gram (by hash) with an earlier one: copies teach once."""
    seen, kept = set(), []
    for text in texts:
        words = text.split()
        grams = {" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))}
        least = set(nsmallest(3, (xxhash.xxh3_64_intdigest(g) for g in grams)))
        if not least & seen:
            kept.append(text)
        seen |= least
    return kept


def _grams(text: str) -> set[str]:
    found = set()
    for word in set(text.split()):
        piece = f" {word}"
        found.update(piece[i : i + GRAM] for i in range(max(1, len(piece) - GRAM + 1)))
    return found


def _marks(toxic: list[str], ordinary: list[str]) -> set[str]:
    seen: Counter[str] = Counter()
    for text in toxic:
        seen.update(_grams(text))
    least = 5 + len(toxic) // 500
    seen = Counter({g: n for g, n in seen.items() if n >= least})
    other: Counter[str] = Counter()
    for text in ordinary:
        other.update(g for g in _grams(text) if g in seen)
    return {g for g, n in seen.items() if n / len(toxic) > LIFT * (other[g] + 1) / len(ordinary)}


def _pieces(texts: list[str], marks: set[str]) -> list[bytes]:
    words = []
    for text in texts:
        for word in text.split():
            piece = f" {word}"
            if any(piece[i : i + GRAM] in marks for i in range(max(1, len(piece) - GRAM + 1))):
                words.append(piece.encode())
    return [b"".join(words[i : i + 8]) for i in range(0, len(words), 8)]


class Model:
    """Two dictionaries and the calibration of their window lengths."""

    def __init__(self, toxic: list[str], ordinary: list[str]):
        self.weights: np.ndarray | None = None
        toxic, ordinary = _unlike([t.lower() for t in toxic]), _unlike([t.lower() for t in ordinary])
        cut_t, cut_o = max(1, len(toxic) * 2 // 3), max(1, len(ordinary) * 2 // 3)
        if len(toxic) < 2 or len(ordinary) < 2:
            return
        rows = []
        for text in ordinary[:cut_o]:
            words = text.encode().split()
            rows += [b" " + b" ".join(words[i : i + 8]) for i in range(0, len(words), 8)]
        body = _trained(rows[:: max(1, len(rows) // 40000)])
        marks = self.marks = _marks(toxic[:cut_t], ordinary[:cut_o])
        self.dictionaries = (body, body + _trained(_pieces(toxic[:cut_t], marks)))
        self._open()
        x = self.features([t.encode() for t in toxic[cut_t:] + ordinary[cut_o:]])
        y = np.repeat([1.0, 0.0], [len(toxic) - cut_t, len(ordinary) - cut_o])
        # Clean texts are the rule: as if four in five were.
        weight = np.where(y == 1, 1 / max(1, y.sum()), 4 / max(1, (1 - y).sum())) * len(y) / 5
        self.mean, self.scale = x.mean(0), x.std(0) + 0.05
        x = np.column_stack([self._scaled(x), np.ones(len(x))])
        w = np.zeros(x.shape[1])
        ridge = np.eye(len(w)) * 1.0
        ridge[-1, -1] = 1e-3
        for _ in range(30):
            p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
            grad = x.T @ (weight * (y - p)) - ridge @ w
            step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge, grad)
            w += np.clip(step, -2, 2)
        self.weights = w

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k != "compressors"}

    def _open(self) -> None:
        settings = zstd.ZstdCompressionParameters.from_level(
            3, min_match=4, write_content_size=0, write_checksum=0, write_dict_id=0
        )
        self.compressors = [
            zstd.ZstdCompressor(
                dict_data=zstd.ZstdCompressionDict(d, dict_type=zstd.DICT_TYPE_RAWCONTENT), compression_params=settings
            )
            for d in self.dictionaries
        ]

    def windows(self, texts: list[bytes]) -> tuple[bytes, np.ndarray, np.ndarray]:
        """All texts after each other, each after a space; windows as (offset, length); the first window of each text."""
        data = b" " + b" ".join(texts)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
        begins = np.cumsum(sizes) - sizes
        gap = np.frombuffer(data, np.uint8) <= 32
        word = np.flatnonzero(gap[:-1] & ~gap[1:])
        word = np.union1d(word, begins)
        owner = np.searchsorted(begins, word, side="right") - 1
        first = np.searchsorted(word, begins)
        starts = word[(np.arange(len(word)) - first[owner]) % WINDOW_WORDS == 0]
        segments = np.stack([starts, np.append(starts[1:], len(data)) - starts], 1).astype(np.uint64)
        return data, segments, np.searchsorted(starts, begins)

    def features(self, texts: list[bytes]) -> np.ndarray:
        data, segments, first = self.windows(texts)
        sizes = []
        for compressor in self.compressors:
            out = compressor.multi_compress_to_buffer(zstd.BufferWithSegments(data, segments.tobytes()), threads=1)
            sizes.append(np.fromiter(map(len, out), np.int64, len(segments)))
        gain = sizes[0] - sizes[1]
        n = np.diff(np.append(first, len(segments)))
        over = np.stack([np.add.reduceat((gain >= t).astype(np.int64), first) for t in THRESHOLDS], 1)
        return np.column_stack(
            [
                np.sqrt(over / n[:, None]),
                np.minimum(over[:, 2], 10) / 10,
                np.maximum.reduceat(gain, first) / 10,
                np.log(n),
            ]
        )

    def _scaled(self, x: np.ndarray) -> np.ndarray:
        """No text weighs more for being longer than those of the calibration."""
        return np.clip((x - self.mean) / self.scale, -6, 6)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        if self.weights is None:
            return np.zeros(len(texts))
        if "compressors" not in self.__dict__:
            self._open()
        x = self._scaled(self.features(texts))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -30, 30)))


def fit(docs: DataFrame, labels: DataFrame, toxic_texts: int = TOXIC_TEXTS, ordinary_texts: int = ORDINARY_TEXTS) -> Model:
    """A model from the rows that may be learned from; labels: doc_id, toxic."""
    known = (
        pick(labels, "doc_id", "toxic")
        .where(F.col("toxic").isNotNull() & learns(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
    )
    order = (F.xxhash64("doc_id"), F.col("doc_id"))
    chosen = known.where("toxic = 1").orderBy(*order).limit(toxic_texts).unionByName(
        known.where("toxic = 0").orderBy(*order).limit(ordinary_texts)
    )
    # The ids chosen are at most as many as the two bounds, so they go to every executor.
    texts = (
        pick(docs, "doc_id", "text")
        .where(F.col("text").isNotNull() & (F.length("text") <= SAMPLE_CHARS))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
    )
    rows = sorted((r["toxic"], r["doc_id"] * 2654435761 % 4294967291, r["text"]) for r in texts.collect())
    return Model([t for k, _, t in rows if k == 1], [t for k, _, t in rows if k == 0])


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)
    schema = schema_with(docs, T.StructField(into, T.DoubleType()))
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in merged(batches, BATCH_BYTES):
            texts = [(t or "").lower().encode() for t in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(shared.value.scores(texts))], names)

    return map_batches(docs, work, schema)
