"""Quality rules from line labels: a linear-chain conditional random field decodes content and boilerplate.

Counts over the whole text give the base rules. Then every line that holds a word is one position of a chain
with two states; Viterbi decoding finds the likeliest labels of a whole text, and the share of its
words that stand in content lines decides. The field is trained here, by its conditional likelihood, on
a bounded sample of labelled documents. Only documents have labels, so those of their lines are latent: lines
start with the label of their document and are judged one by one, without the chain; then, in turn, Viterbi decoding
labels the lines anew, as far as the share of content still says what the label of the document says, and the field is fitted to
them. So boilerplate inside good documents and content inside bad ones are learnt as what they are.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.statistics import Measured
from habispark.llm.words import read_texts, slices, sums_by_text

# Bounds of the training sample: documents, and consecutive lines drawn from one of them.
SAMPLE_DOCUMENTS = 3000
SAMPLE_LINES = 64
MIN_WORDS = 50
CONTENT_SHARE = 0.5
# Fits to lines labelled anew.
ROUNDS = 3
# Steps of the first fit, and of each one that goes on from it.
_STEPS, _MORE_STEPS = 150, 50
_RULED = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, content_share double"
)


@dataclass(frozen=True)
class LineModel:
    """Score of content over boilerplate per feature, and of each step from state to state (1: content)."""

    weights: np.ndarray
    steps: np.ndarray

    def content(self, features: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Likeliest labels of all lines; `first` says where each text's lines begin. Ties go to content."""
        score = np.zeros((len(features), 2))
        score[:, 1] = features @ self.weights
        counts = np.diff(first)
        back = np.zeros((len(features), 2), np.int8)
        order = np.argsort(-counts, kind="stable")
        begins, lengths = first[:-1][order], counts[order]
        active = int((lengths > 0).sum())
        best = score[begins[:active]]
        final = best.copy()
        for t in range(1, int(lengths[0]) if len(lengths) else 0):
            active = int(np.searchsorted(-lengths, -t))  # texts with more than t lines
            at = begins[:active] + t
            to = best[:active, :, None] + self.steps[None]
            back[at] = np.where(to[:, 1] >= to[:, 0], 1, 0)
            best = to.max(axis=1) + score[at]
            final[:active] = best
        state = (final[:, 1] >= final[:, 0]).astype(np.int8)
        out = np.zeros(len(features), np.int8)
        for t in range(int(lengths[0]) - 1 if len(lengths) else -1, -1, -1):
            active = int(np.searchsorted(-lengths, -t))
            at = begins[:active] + t
            out[at] = state[:active]
            if t:
                state[:active] = back[at, state[:active]]
        return out.astype(bool)


def _climb(x: np.ndarray, y: np.ndarray, real: np.ndarray, weight: np.ndarray, model: LineModel, chain: bool) -> LineModel:
    """Maximises the conditional likelihood of the line labels y, with a small penalty, by Adam, from `model` on.
    Without `chain` every line is judged by itself."""
    longest, width = x.shape[1:]
    seen = [(y == label) & real for label in (0, 1)]
    w, steps = model.weights.copy(), model.steps.copy()
    moments = [np.zeros(width + 4), np.zeros(width + 4)]
    share = real[:, 1:] * weight[:, None]
    observed = np.array([[(share * a[:, :-1] * b[:, 1:]).sum() for b in seen] for a in seen])
    for step in range(1, (_MORE_STEPS if chain else _STEPS) + 1):
        # Forward and backward recursions, scaled at every position.
        score = np.ones((len(x), longest, 2))
        score[..., 1] = np.exp(np.clip(x @ w, -30, 30))
        move = np.exp(steps)
        ahead, scale = np.zeros_like(score), np.ones((len(x), longest, 1))
        for t in range(longest):
            now = (ahead[:, t - 1] @ move if t else 1.0) * score[:, t]
            scale[:, t] = now.sum(axis=1, keepdims=True)
            ahead[:, t] = now / scale[:, t]
        behind = np.ones_like(score)
        for t in range(longest - 2, -1, -1):
            onward = (score[:, t + 1] * behind[:, t + 1]) @ move.T / scale[:, t + 1]
            behind[:, t] = np.where(real[:, t + 1, None], onward, 1)
        here = ahead * behind * real[..., None]
        gradient = np.einsum("itf,it->f", x, (y - here[..., 1]) * real * weight[:, None])
        joint = np.einsum("ita,itb,it->ab", ahead[:, :-1], (score * behind / scale)[:, 1:], share) * move
        pairs = observed - joint if chain else np.zeros((2, 2))
        g = np.concatenate([gradient - 1e-3 * w, (pairs - 1e-2 * steps).ravel()])
        moments[0] = 0.9 * moments[0] + 0.1 * g
        moments[1] = 0.99 * moments[1] + 0.01 * g * g
        change = 0.1 * (moments[0] / (1 - 0.9**step)) / (np.sqrt(moments[1] / (1 - 0.99**step)) + 1e-9)
        w, steps = w + change[:width], steps + change[width:].reshape(2, 2)
    return LineModel(w, steps)


def relabelled(model: LineModel, lines: np.ndarray, first: np.ndarray, quality: np.ndarray) -> np.ndarray:
    """The likeliest labels of all lines, changed where a text's share of words in content lines contradicts its quality: the
    lines nearest to the other label change first, until it does not."""
    content, score, words = model.content(lines, first), lines @ model.weights, np.expm1(3 * lines[:, 1].astype(np.float64))
    for a, b, good in zip(first[:-1], first[1:], quality == 1, strict=True):
        have, total = words[a:b][content[a:b]].sum(), words[a:b].sum()
        for i in a + np.argsort(-score[a:b] if good else score[a:b], kind="stable"):
            if (have >= CONTENT_SHARE * total) == good:
                break
            if content[i] != good:
                content[i] = good
                have += words[i] if good else -words[i]
    return content


def fit(texts: list[tuple[np.ndarray, int]]) -> LineModel:
    """The field of texts, given as the features of their lines and their quality. Without both qualities every line
    counts as content."""
    width = len(texts[0][0][0]) if texts else 0
    if not texts or len({y for _, y in texts}) < 2:
        return LineModel(np.zeros(max(width, 11)), np.zeros((2, 2)))
    quality = np.array([label for _, label in texts])
    lengths = np.array([len(f) for f, _ in texts])
    lines, first = np.concatenate([f for f, _ in texts]), np.concatenate([[0], np.cumsum(lengths)])
    real = np.arange(lengths.max())[None] < lengths[:, None]
    x, y = np.zeros((*real.shape, width)), np.zeros(real.shape)
    x[real], y[real] = lines, np.repeat(quality, lengths)
    # Both classes weigh the same, as does every text.
    weight = np.where(quality == 1, 0.5 / (quality == 1).mean(), 0.5 / (quality == 0).mean()) / lengths / len(texts)
    model = _climb(x, y, real, weight, LineModel(np.zeros(width), np.zeros((2, 2))), chain=False)
    for _ in range(ROUNDS):
        y[real] = relabelled(model, lines, first, quality)
        model = _climb(x, y, real, weight, model, chain=True)
    return model


def train(docs: DataFrame, labels: DataFrame) -> LineModel:
    """Fits the field on at most SAMPLE_DOCUMENTS of the labelled documents, the ones whose ids hash lowest.

    `labels` has doc_id and quality. Without both kinds of labels every line counts as content.
    """
    chosen = (
        labels.filter(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1))
        .select(F.col("doc_id").alias("labelled"), "quality")
        .orderBy(F.xxhash64("labelled"), "labelled", "quality")
        .limit(SAMPLE_DOCUMENTS)
    )

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                measured = Measured(read_texts(part.column("text")))
                features, first = measured.line_features(), measured.first_line
                # Where the lines of a longer text begin follows from all its words, so every part of it can be drawn.
                draw = sums_by_text((measured.hashes >> np.uint64(33)).astype(np.int64), measured.texts.first)
                begin = first[:-1] + draw % (np.maximum(np.diff(first) - SAMPLE_LINES, 0) + 1)
                rows = [features[a : min(b, a + SAMPLE_LINES)].tobytes() for a, b in zip(begin, first[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("quality"), pa.array(rows, pa.binary())], ["quality", "features"]
                )

    # Broadcast: at most SAMPLE_DOCUMENTS rows of two numbers.
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("labelled"))
        .select(F.col("quality").cast("int").alias("quality"), "text")
        .mapInArrow(lines, "quality int, features binary")
        .limit(2 * SAMPLE_DOCUMENTS)
        .toArrow()
    )
    width = Measured(read_texts(pa.array([], pa.string()))).line_features().shape[1]
    rows = sorted(zip(sample["features"].to_pylist(), sample["quality"].to_pylist(), strict=True))
    return fit([(np.frombuffer(f, np.float32).reshape(-1, width), q) for f, q in rows if f])


def _verdict(m: Measured, model: LineModel) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Base rule failed, kept, content share, for every text."""
    words = np.diff(m.line_words, axis=0)[0] * model.content(m.line_features(), m.first_line)
    total = np.concatenate([[0], np.cumsum(words)])
    n = m.texts.counts
    share = (total[m.first_line[1:]] - total[m.first_line[:-1]]) / np.maximum(n, 1)
    failed = (n < MIN_WORDS) | (100 * m.n_repeat_words > 50 * n)
    return failed, ~failed & (share >= CONTENT_SHARE), share


def ruled(docs: DataFrame, model: LineModel, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Counts and verdict for every row of `docs`.

    NULL, empty and blank texts have no words and fail the base rule. content_share is the share of words
    in content lines, 0 without words; ties of labels go to content. Rows are judged one by one: NULL or repeated
    identifiers and repeated rows are passed through, and an empty table gives an empty result. A text of any length is read whole, by
    one task, and its lines are one chain. Other columns of `docs` may have any name.
    """

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                m = Measured(read_texts(part.column("text")))
                failed, kept, share = _verdict(m, model)
                numbers = [m.texts.counts, m.word_chars, m.n_symbols, m.n_dup_lines, m.n_repeat_words]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        *[pa.array(x.astype(np.int64)) for x in numbers],
                        pa.array(failed),
                        pa.array(kept),
                        pa.array(share.astype(np.float64)),
                    ],
                    names=[x.split()[0] for x in _RULED.split(", ")],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(judge, _RULED)


def passing(docs: DataFrame, model: LineModel, text: str = "text") -> DataFrame:
    """The rows of `docs` that `ruled` keeps, with all columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text):
                m = Measured(read_texts(part.column(text)))
                yield part.filter(pa.array(_verdict(m, model)[1]))

    return docs.mapInArrow(keep, docs.schema)
