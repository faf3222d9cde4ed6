"""Language identification: a bidirectional gated recurrent network over bytes, trained here by backpropagation.

Two recurrences of ``HIDDEN`` gated units run over a text's bytes, one from each side, and a softmax over both states
labels every position; a document's probabilities are the mean over its positions in words.  For speed the squashing
functions are rational (x / (1 + |x|)), and a long text is read in chunks of ``CHUNK`` bytes, each with ``MARGIN`` bytes
of context on both sides; every byte is labelled once.  A chunk is the network's whole memory, so a text's length does
not matter.

Training uses a bounded sample: about ``TEXTS_PER_LANGUAGE`` excerpts of ``EXCERPT`` code points from random places of
texts that may be learned from, for at most ``LANGUAGES`` languages (the most frequent ones), chosen by a hash of the
id.  Prediction reads every text whole.

Null texts and texts without any letter are ``und`` with score 0.  Repeated rows are labelled alike.  Without labels
to learn from, everything is ``und``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from spendloom.llm.common import learns, map_batches, merged, pick, schema_with

HIDDEN = 8
CHUNK = 128
MARGIN = 8
EXCERPT = 128
TEXTS_PER_LANGUAGE = 1500
LANGUAGES = 64
STEPS = 400
ROWS = 128
BATCH_BYTES = 4 << 20
#: Chunks that run through the network side by side.
SIDE_BY_SIDE = 2048
UNKNOWN = "und"

#: Bytes that do not tell a language: a position there is labelled but doesn't count for the document.
PLAIN = np.array([not (65 <= b <= 90 or 97 <= b <= 122 or b >= 128) for b in range(256)])


def _squash(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


def _gate(x: np.ndarray) -> np.ndarray:
    return 0.5 + 0.5 * _squash(x)


class Network:
    """Arrays are (texts, units), and contiguous for each gate: z keeps, r resets, n is the new state."""

    def __init__(self, languages: list[str], hidden: int = HIDDEN, seed: int = 7):
        rng = np.random.default_rng(seed)
        self.languages, self.hidden = languages, hidden
        self.params = {}
        for side in "fb":
            for gate in "zrn":
                self.params[f"x{gate}{side}"] = rng.normal(0, 0.5, (256, hidden)).astype(np.float32)
                self.params[f"u{gate}{side}"] = rng.normal(0, hidden**-0.5, (hidden, hidden)).astype(np.float32)
        self.params["o"] = rng.normal(0, hidden**-0.5, (2 * hidden, len(languages))).astype(np.float32)
        self.params["ob"] = np.zeros(len(languages), np.float32)

    def run(self, data: np.ndarray, side: str, tape: list | None = None) -> np.ndarray:
        """States (time, texts, units) for bytes (time, texts)."""
        xz, xr, xn = (self.params[f"x{g}{side}"] for g in "zrn")
        uz, ur, un = (self.params[f"u{g}{side}"] for g in "zrn")
        times = range(len(data)) if side == "f" else range(len(data) - 1, -1, -1)
        out = np.empty((*data.shape, self.hidden), np.float32)
        state = np.zeros((data.shape[1], self.hidden), np.float32)
        for t in times:
            byte = data[t]
            az = state @ uz
            az += np.take(xz, byte, 0, mode="clip")
            ar = state @ ur
            ar += np.take(xr, byte, 0, mode="clip")
            z, r = _gate(az), _gate(ar)
            back = r * state
            an = back @ un
            an += np.take(xn, byte, 0, mode="clip")
            new = _squash(an)
            if tape is not None:
                tape.append((t, state, az, ar, an, z, r, back, new))
            state = np.subtract(state, new, out=out[t])
            state *= z
            state += new
        return out

    def labels(self, data: np.ndarray) -> np.ndarray:
        """Probabilities (time, texts, languages) of every position."""
        h, data = self.hidden, data.astype(np.intp)
        o = self.run(data, "f").reshape(-1, h) @ self.params["o"][:h]
        o += self.run(data, "b").reshape(-1, h) @ self.params["o"][h:]
        o += self.params["ob"]
        np.clip(o, -30, 30, out=o)
        np.exp(o, out=o)
        o /= (o @ np.ones(o.shape[1], np.float32))[:, None]
        return o.reshape(*data.shape, -1)

    def gradients(self, data: np.ndarray, label: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Loss and gradients by backpropagation through time; every letter's position should have its text's label."""
        p, h, tapes = self.params, self.hidden, {"f": [], "b": []}
        weight = (~PLAIN[data]).astype(np.float32)
        weight /= max(1.0, weight.sum())
        data = data.astype(np.intp)
        states = np.concatenate([self.run(data, s, tapes[s]) for s in "fb"], 2)
        o = states @ p["o"] + p["ob"]
        e = np.exp(o - o.max(2, keepdims=True))
        prob = e / e.sum(2, keepdims=True)
        time, text = np.indices(data.shape)
        loss = float(-(weight * np.log(prob[time, text, label[text]] + 1e-9)).sum())
        do = prob * weight[:, :, None]
        do[time, text, label[text]] -= weight
        grads = {k: np.zeros_like(v) for k, v in p.items()}
        grads["o"] = states.reshape(-1, 2 * h).T @ do.reshape(-1, do.shape[2])
        grads["ob"] = do.sum((0, 1))
        dstates = do @ p["o"].T
        for k, side in enumerate("fb"):
            uz, ur, un = (p[f"u{g}{side}"] for g in "zrn")
            own = dstates[:, :, k * h : (k + 1) * h]
            dstate = np.zeros((data.shape[1], h), np.float32)
            given = {g: np.empty((*data.shape, h), np.float32) for g in "zrn"}
            for t, state, az, ar, an, z, r, back, new in reversed(tapes[side]):
                d = dstate + own[t]
                dn = d * (1 - z) / (1 + np.abs(an)) ** 2
                dback = dn @ un.T
                dz = d * (state - new) * 0.5 / (1 + np.abs(az)) ** 2
                dr = dback * state * 0.5 / (1 + np.abs(ar)) ** 2
                dstate = d * z + dback * r + dz @ uz.T + dr @ ur.T
                grads[f"un{side}"] += back.T @ dn
                grads[f"uz{side}"] += state.T @ dz
                grads[f"ur{side}"] += state.T @ dr
                given["z"][t], given["r"][t], given["n"][t] = dz, dr, dn
            for gate, g in given.items():
                flat, byte = g.reshape(-1, h), data.ravel()
                for unit in range(h):
                    grads[f"x{gate}{side}"][:, unit] = np.bincount(byte, flat[:, unit], 256)
        return loss, grads

    def train(self, texts: list[bytes], label: np.ndarray, steps: int = STEPS, rows: int = ROWS, seed: int = 11) -> None:
        """Adam over random batches with as many rows of each language; texts are cut or repeated to CHUNK bytes."""
        rng = np.random.default_rng(seed)
        data = np.stack([np.frombuffer((t * (CHUNK // len(t) + 1))[:CHUNK], np.uint8) for t in texts], 1)
        groups = [np.flatnonzero(label == k) for k in range(len(self.languages))]
        first = {k: np.zeros_like(v) for k, v in self.params.items()}
        second = {k: np.zeros_like(v) for k, v in self.params.items()}
        for step in range(1, steps + 1):
            chosen = np.array([rng.choice(groups[i % len(groups)]) for i in range(rows)])
            _, grads = self.gradients(data[:, chosen], label[chosen])
            rate = 0.02 * (1 - step / (steps + 1)) + 0.001
            for k, g in grads.items():
                g = np.clip(g, -1, 1)
                first[k] += 0.1 * (g - first[k])
                second[k] += 0.01 * (g * g - second[k])
                self.params[k] -= rate * (first[k] / (1 - 0.9**step)) / (np.sqrt(second[k] / (1 - 0.99**step)) + 1e-8)

    def documents(self, texts: list[bytes]) -> np.ndarray:
        """Probabilities (texts, languages), pooled over the positions in words; 0 for texts without any."""
        body = CHUNK - 2 * MARGIN
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        pad = b" " * MARGIN
        data = np.frombuffer(pad + b"".join(texts) + b" " * CHUNK, np.uint8)
        begins = np.cumsum(sizes) - sizes + MARGIN
        chunks = -(-sizes // body)
        owner = np.repeat(np.arange(len(texts)), chunks)
        inner = np.arange(chunks.sum()) - np.repeat(np.cumsum(chunks) - chunks, chunks)
        start = begins[owner] + inner * body
        length = np.minimum(body, begins[owner] + sizes[owner] - start)
        lo, hi = begins[owner], begins[owner] + sizes[owner]
        total = np.zeros((len(texts), len(self.languages)))
        count = np.zeros(len(texts))
        offsets = np.arange(-MARGIN, CHUNK - MARGIN)[:, None]
        for i in range(0, len(start), SIDE_BY_SIDE):
            part = slice(i, i + SIDE_BY_SIDE)
            at = start[part] + offsets
            # A neighbour's bytes are no context: beyond the text's ends stand spaces.
            view = np.where((at >= lo[part]) & (at < hi[part]), data[at], 32).astype(np.uint8)
            prob = self.labels(view)[MARGIN : CHUNK - MARGIN]
            mine = view[MARGIN : CHUNK - MARGIN]
            weight = ~PLAIN[mine] & (np.arange(body)[:, None] < length[part])
            prob *= weight[:, :, None]
            np.add.at(total, owner[part], prob.sum(0))
            np.add.at(count, owner[part], weight.sum(0))
        return total / np.maximum(count, 1)[:, None]


def fit(docs: DataFrame, texts_per_language: int = TEXTS_PER_LANGUAGE, languages: int = LANGUAGES) -> Network | None:
    """A network trained on rows with a language that may be learned from (columns doc_id, text, lang)."""
    known = pick(docs, "doc_id", "text", "lang").where(
        F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}") & learns(F.col("doc_id"))
    )
    counts = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(languages).collect()
    if not counts:
        return None
    share = F.lit(0.0)
    for row in counts:
        share = F.when(F.col("lang") == row["lang"], min(1.0, texts_per_language / row["count"])).otherwise(share)
    # Copies fall to the same side, so a large group of copies is in the sample once for each row or not at all.
    draw = F.pmod(F.xxhash64("doc_id", F.lit("draw")), F.lit(1 << 30)) / float(1 << 30)
    place = F.pmod(F.xxhash64("doc_id", F.lit("place")), F.greatest(F.lit(1), F.length("text") - EXCERPT + 1)) + 1
    sample = known.where(draw < share).select(
        "lang", F.expr("doc_id").alias("doc_id"), F.substring("text", place.cast("int"), F.lit(EXCERPT)).alias("text")
    )
    rows = sorted((r["lang"], r["doc_id"], r["text"]) for r in sample.collect())
    names = sorted(r["lang"] for r in counts)
    texts = [t.encode() for _, _, t in rows]
    label = np.array([names.index(k) for k, _, _ in rows])
    present = sorted(set(label.tolist()))
    if len(present) < len(names):  # a rare language of which the draw has no row
        names = [names[k] for k in present]
        label = np.searchsorted(present, label)
    network = Network(names)
    network.train(texts, label)
    return network


def predict(
    docs: DataFrame, network: Network | None, text: str = "text", into: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the language of each whole text and its pooled probability."""
    shared = docs.sparkSession.sparkContext.broadcast(network)
    at = docs.columns.index(text)
    schema = schema_with(docs, T.StructField(into[0], T.StringType()), T.StructField(into[1], T.DoubleType()))
    names = schema.fieldNames()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in merged(batches, BATCH_BYTES):
            texts = batch.column(at)
            letter = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            found = np.full(batch.num_rows, UNKNOWN, object)
            score = np.zeros(batch.num_rows)
            some = np.flatnonzero(letter)
            if model is not None and some.size:
                prob = model.documents(texts.take(pa.array(some)).cast(pa.binary()).to_pylist())
                best = prob.argmax(1)
                found[some] = np.array(model.languages, object)[best]
                score[some] = np.minimum(prob[np.arange(len(best)), best], 1.0)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string()), pa.array(score)], names)

    return map_batches(docs, work, schema)
