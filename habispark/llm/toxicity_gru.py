"""Toxicity: a bidirectional gated recurrent network with attention pooling over overlapping windows of words.

Every word enters with a word input (its hash bucket) and a character input (the hashed four-letter slices of the
word). The input tables hold the log-odds of a bucket between toxic and clean training documents next to fixed random
coordinates; the network on top is trained here in NumPy by backpropagation through time. Labels belong to
documents, so training alternates between finding each document's strongest window and fitting these
windows. A document scores as its strongest window, over all windows of the whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import remainder
from habispark.llm.words import Texts, mix, read_texts, slices

LENGTH, STRIDE = 24, 12
HIDDEN = 8
WORD_BUCKETS, SLICE_BUCKETS = 1 << 16, 1 << 15
SLICE = 4
# Bounds of the training sample: documents of each class, and characters of one of them. Longer documents are not drawn,
# so every sampled text is read whole.
SAMPLE_DOCUMENTS = 1200
SAMPLE_CHARS = 1 << 14
THRESHOLD = 0.3
# Times that the strongest windows are found anew, and steps of training after each: the same for any size of the sample.
_ROUNDS, _STEPS, _BATCH, _RATE = 8, 75, 256, 0.02
_INPUTS = 12


@dataclass(frozen=True)
class Tables:
    words: np.ndarray
    slices: np.ndarray


def word_buckets(texts: Texts) -> np.ndarray:
    return (texts.hashes() >> np.uint64(48)).astype(np.int64) % WORD_BUCKETS


def slice_buckets(texts: Texts) -> np.ndarray:
    """For every byte the bucket of the SLICE bytes that begin there; separators pad the end of a word."""
    padded = np.concatenate([texts.data, np.full(SLICE, 0x20, np.uint8)]).astype(np.uint64)
    value = np.zeros(len(texts.data), np.uint64)
    for i in range(SLICE):
        value = value * np.uint64(257) + padded[i : i + len(value)]
    return (mix(value) >> np.uint64(49)).astype(np.int64) % SLICE_BUCKETS


def inputs(texts: Texts, tables: Tables) -> np.ndarray:
    """One row per word, then one row of zeros for the places behind a short text."""
    n = len(texts.start)
    out = np.zeros((n + 1, _INPUTS), np.float32)
    if not n:
        return out
    out[:n, :5] = tables.words[word_buckets(texts)]
    # A slice counts for the word that holds its first byte; the bytes between words count for none.
    values = tables.slices[slice_buckets(texts)]
    inside = np.zeros(len(texts.data) + 1, np.int64)
    inside[texts.start] += 1
    np.add.at(inside, texts.end, -1)
    values[np.cumsum(inside)[:-1] == 0] = 0
    lengths = (texts.end - texts.start)[:, None]
    out[:n, 5:10] = np.add.reduceat(values, texts.start, axis=0) / lengths
    out[:n, 10] = np.maximum.reduceat(values[:, 0], texts.start)
    out[:n, 11] = np.log1p(lengths[:, 0]) / 3
    return out


def windows(first: np.ndarray, pad: int) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers (windows x LENGTH, `pad` behind the end of a text) and the text of each window."""
    counts = np.diff(first)
    number = np.where(counts > 0, np.maximum(-(-(counts - LENGTH) // STRIDE), 0) + 1, 0)
    owner = np.repeat(np.arange(len(counts)), number)
    nth = np.arange(len(owner)) - np.repeat(np.cumsum(number) - number, number)
    at = (first[owner] + nth * STRIDE)[:, None] + np.arange(LENGTH)
    return np.where(at < first[owner + 1][:, None], at, pad), owner


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * np.tanh(0.5 * x) + 0.5


class Network:
    """Parameters by name; `forward` keeps what `backward` needs only if asked to."""

    def __init__(self, seed: int = 5):
        rng = np.random.RandomState(seed)
        draw = lambda *shape: rng.normal(0, 0.3, shape).astype(np.float32)
        self.p = {
            f"{k}{d}": v
            for d in "fb"
            for k, v in (
                ("w", draw(_INPUTS, 3 * HIDDEN)),
                ("u", draw(HIDDEN, 3 * HIDDEN)),
                ("c", np.zeros(3 * HIDDEN, np.float32)),
            )
        } | {"attend": draw(2 * HIDDEN), "out": draw(2 * HIDDEN), "bias": np.zeros(1, np.float32)}

    def forward(self, x: np.ndarray, at: np.ndarray, keep: bool = False):
        """Logit per window. x: inputs of all words, the last row being the padding."""
        p, h3 = self.p, HIDDEN
        size = len(at)
        states = np.zeros((LENGTH, size, 2 * HIDDEN), np.float32)
        kept = {}
        for d, steps, part in (("f", range(LENGTH), slice(0, h3)), ("b", range(LENGTH - 1, -1, -1), slice(h3, 2 * h3))):
            # Few windows need few of the words; many share theirs.
            words = None if at.size < len(x) else x @ p[f"w{d}"] + p[f"c{d}"]
            h = np.zeros((size, HIDDEN), np.float32)
            trace = []
            for t in steps:
                a = x[at[:, t]] @ p[f"w{d}"] + p[f"c{d}"] if words is None else words[at[:, t]]
                g = h @ p[f"u{d}"]
                gates = _sigmoid(a[:, : 2 * h3] + g[:, : 2 * h3])
                z, r = gates[:, :h3], gates[:, h3:]
                n = np.tanh(a[:, 2 * h3 :] + r * g[:, 2 * h3 :])
                if keep:
                    trace.append((t, h, z, r, n, g[:, 2 * h3 :]))
                h = n + z * (h - n)
                states[t, :, part] = h
            kept[d] = trace
        attention = states @ p["attend"]
        attention = np.where(at.T == len(x) - 1, -1e9, attention)
        attention = np.exp(attention - attention.max(axis=0))
        attention /= attention.sum(axis=0)
        pooled = np.einsum("tb,tbh->bh", attention, states)
        logit = pooled @ p["out"] + p["bias"]
        return (logit, (states, attention, pooled, kept)) if keep else logit

    def backward(self, x: np.ndarray, at: np.ndarray, memory: tuple, d_logit: np.ndarray) -> dict[str, np.ndarray]:
        p, h3 = self.p, HIDDEN
        states, attention, pooled, kept = memory
        grad = {"out": pooled.T @ d_logit, "bias": d_logit.sum(keepdims=True)}
        d_pooled = d_logit[:, None] * p["out"]
        spread = np.einsum("tbh,bh->tb", states, d_pooled)
        d_attention = attention * (spread - (attention * spread).sum(axis=0))
        grad["attend"] = np.einsum("tb,tbh->h", d_attention, states)
        d_states = attention[..., None] * d_pooled + d_attention[..., None] * p["attend"]
        for d, part in (("f", slice(0, h3)), ("b", slice(h3, 2 * h3))):
            w, u, c = (np.zeros_like(p[f"{k}{d}"]) for k in "wuc")
            carry = np.zeros((len(at), HIDDEN), np.float32)
            for t, h, z, r, n, g in reversed(kept[d]):
                dh = carry + d_states[t, :, part]
                dn = dh * (1 - z) * (1 - n * n)
                dz = dh * (h - n) * z * (1 - z)
                dr = dn * g * r * (1 - r)
                da = np.concatenate([dz, dr, dn], axis=1)
                dg = np.concatenate([dz, dr, dn * r], axis=1)
                w += x[at[:, t]].T @ da
                c += da.sum(axis=0)
                u += h.T @ dg
                carry = dh * z + dg @ p[f"u{d}"].T
            grad |= {f"w{d}": w, f"u{d}": u, f"c{d}": c}
        return grad


@dataclass(frozen=True)
class Toxicity:
    tables: Tables
    network: Network

    def score(self, texts: Texts) -> np.ndarray:
        """Probability per text; a text without words scores 0."""
        best = np.full(texts.count, -np.inf)
        x = inputs(texts, self.tables)
        at, owner = windows(texts.first, len(x) - 1)
        if len(at):
            np.maximum.at(best, owner, self.network.forward(x, at))
        return 1 / (1 + np.exp(-np.clip(best, -500, 500))) * (texts.counts > 0)


def _holders(buckets: np.ndarray, owner: np.ndarray, toxic: np.ndarray, size: int) -> np.ndarray:
    """By class and bucket, the number of texts that have it."""
    pairs = np.unique(owner * size + buckets)
    return np.stack([np.bincount(pairs[toxic[pairs // size] == y] % size, minlength=size) for y in (0, 1)])


def fit(column: pa.Array, toxic: np.ndarray) -> Toxicity:
    rng = np.random.RandomState(11)
    words = rng.normal(0, 0.2, (WORD_BUCKETS, 5)).astype(np.float32)
    parts = rng.normal(0, 0.2, (SLICE_BUCKETS, 5)).astype(np.float32)
    model = Toxicity(Tables(words, parts), Network())
    if len(set(toxic.tolist())) < 2:
        return model
    # Slice by slice, so that only the inputs of all words are held at once.
    sample = list(slices(pa.RecordBatch.from_arrays([column, pa.array(toxic)], ["text", "toxic"]), "text"))
    holders = [np.zeros((2, WORD_BUCKETS)), np.zeros((2, SLICE_BUCKETS))]
    for part in sample:
        texts, y = read_texts(part.column("text"), lower=True), part.column("toxic").to_numpy()
        holders[0] += _holders(word_buckets(texts), texts.owner(), y, WORD_BUCKETS)
        byte_owner = np.repeat(np.arange(texts.count), np.diff(texts.offsets))
        holders[1] += _holders(slice_buckets(texts), byte_owner, y, SLICE_BUCKETS)
    total = [(toxic == y).sum() for y in (0, 1)]

    def log_odds(has: np.ndarray, own: int | None) -> np.ndarray:
        """With the text itself left out of the counts of its class `own`."""
        has = [np.maximum(has[y] - (own == y), 0) for y in (0, 1)]
        return np.log((has[1] + 2) / (total[1] + 4)) - np.log((has[0] + 2) / (total[0] + 4))

    network = model.network
    rows, counts, truth = [], [], []
    for label in (0, 1):
        words[:, 0], parts[:, 0] = (log_odds(has, label) for has in holders)
        for part in sample:
            own = part.column("text").filter(pa.array(part.column("toxic").to_numpy() == label))
            texts = read_texts(own, lower=True)
            rows.append(inputs(texts, model.tables)[:-1])
            counts.append(texts.counts)
            truth.append(np.full(len(own), label))
    words[:, 0], parts[:, 0] = (log_odds(has, None) for has in holders)
    toxic = np.concatenate(truth)
    x = np.concatenate([*rows, np.zeros((1, _INPUTS), np.float32)])
    at, owner = windows(np.concatenate([[0], np.cumsum(np.concatenate(counts))]), len(x) - 1)
    lead = np.maximum(x[:, 0], x[:, 10])[at].max(axis=1)
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in network.p.items()}
    step = 0
    for turn in range(_ROUNDS):
        # The window that stands for its document: first by the inputs alone, then by the network.
        value = lead if turn == 0 else np.concatenate([network.forward(x, at[i : i + 8192]) for i in range(0, len(at), 8192)])
        order = np.lexsort((-value, owner))
        top = order[np.concatenate([[True], owner[order][1:] != owner[order][:-1]])]
        clean = np.flatnonzero(toxic[owner] == 0)
        extra = rng.choice(clean, min(len(clean), len(top)), replace=False)
        chosen = np.concatenate([top, extra])
        # Whole permutations one after another, cut into equal steps.
        drawn = np.concatenate([rng.permutation(chosen) for _ in range(-(-_STEPS * _BATCH // len(chosen)))])
        for part in drawn[: _STEPS * _BATCH].reshape(_STEPS, _BATCH):
            logit, memory = network.forward(x, at[part], keep=True)
            d_logit = ((_sigmoid(logit) - toxic[owner[part]]) / len(part)).astype(np.float32)
            step += 1
            for k, g in network.backward(x, at[part], memory, d_logit).items():
                g = np.clip(g, -1, 1)
                m, v = moments[k]
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                network.p[k] -= _RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Toxicity:
    """Fits on at most SAMPLE_DOCUMENTS labelled documents of each class, the ones whose ids hash lowest, without those
    of more than SAMPLE_CHARS characters.

    `labels` has doc_id and toxic; other values than 0 and 1 are ignored.
    """
    short = docs.filter(F.coalesce(F.char_length(F.col(text)), F.lit(0)) <= SAMPLE_CHARS).select(F.col(doc_id).alias("sampled"), F.col(text).alias("text"))
    known = labels.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").alias("labelled"), F.col("toxic").cast("int").alias("toxic"))
    # Labels without a document that can be drawn go before the lot is drawn, so they take no place in it.
    known = known.join(short.select("sampled"), F.col("sampled") == F.col("labelled"), "left_semi")
    order = (F.xxhash64("labelled"), "labelled")
    chosen = known.filter(F.col("toxic") == 1).orderBy(*order).limit(SAMPLE_DOCUMENTS).unionByName(
        known.filter(F.col("toxic") == 0).orderBy(*order).limit(SAMPLE_DOCUMENTS)
    )
    sample = (
        short
        # Broadcast: at most 2 * SAMPLE_DOCUMENTS rows of two numbers.
        .join(F.broadcast(chosen), F.col("sampled") == F.col("labelled"))
        .select("sampled", "toxic", "text")
        .limit(4 * SAMPLE_DOCUMENTS)
        .toArrow()
        .sort_by([("sampled", "ascending"), ("toxic", "ascending"), ("text", "ascending")])
    )
    return fit(sample["text"].combine_chunks(), sample["toxic"].to_numpy().astype(np.int64))


def scored(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 4, held: int = 2) -> DataFrame:
    """doc_id, held_out, score, predicted for every row of `docs`.

    Labels are learned from rows whose id's crc32 modulo `folds` is not `held`. NULL, empty and blank texts score 0.
    Repeated identifiers are scored each; a NULL one has remainder 0. Without labels of both classes the network stays
    untrained. An empty table gives an empty result; other columns of `docs` may have any name.
    """
    model = train(docs, labels.filter(remainder(F.col("doc_id"), folds) != held), doc_id, text)
    # Numbers of fixed size, about 2 MB.
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                score = shared.value.score(read_texts(part.column("text"), lower=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("held_out"),
                        pa.array(score.astype(np.float64)),
                        pa.array((score >= THRESHOLD).astype(np.int32)),
                    ],
                    ["doc_id", "held_out", "score", "predicted"],
                )

    return docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (remainder(F.col(doc_id), folds) == held).alias("held_out"),
        F.col(text).alias("text"),
    ).mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int")
