"""Language-model scores from a hierarchical Pitman-Yor model of the words of a corpus.

Restaurants form a tree: the root; below it one per last two bytes of the preceding word; below each of those one
per whole preceding word (its 64-bit hash), so contexts that end alike share a parent. A restaurant seats the words that follow
its context; every table it opens sends one customer to its parent, and the root's tables go to a uniform
base over the known words and one unknown. Seatings are sampled by blocked Gibbs sweeps: all customers of one
word in one restaurant are seated anew given its parent and the totals of the restaurant. Predictive
probabilities are averaged over SAMPLES sweeps.

Everything about a word lies in the bucket of its hash, and buckets are stored as they are dealt, so sweeps run bucket
by bucket and move none of them; buckets share only the totals of the restaurants. Those of the root and of the 65,536 endings go to every task; those of the
preceding words are added up by slots of their hashes and go to the buckets that ask for them. Texts are
packed into chunks, which are stored as numbers of their words; equal (word, context) pairs of a chunk are counted before they travel.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.packed import pack, pack_even, unpack, unpack_even
from habispark.llm.tables import dealt, discard, remainder, stored, stored_at
from habispark.llm.words import read_texts, slices

CHUNK_TOKENS = 2_000_000
BUCKET_TOKENS = 1_000_000
STRENGTH = 1.0
BURN_IN, SAMPLES = 2, 3
# Customers of one word that are seated one by one; beyond, in doublings, by the expected rate.
ONE_BY_ONE = 64
_END = np.uint64(0x1234567)
_CHUNK = "chunk long, ids binary, missing binary, trained binary, counts binary, tokens binary, words binary, endings binary"
_PIECE = "chunk long, bucket int, words binary, pairs binary, contexts binary, counts binary, leaves binary, endings binary"
_SCORES = "doc_id long, n_tokens long, n_known long, base_score double, score double"


def _pack_chunks(limit: int):
    """Chunks of texts of `limit` tokens or a little more: their distinct words, and every token as the number of its word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        parts: list[tuple] = []
        chunk = TaskContext.get().partitionId() << 24

        def close() -> pa.RecordBatch:
            words, ends, trained, counts, ids, missing = (np.concatenate(x) for x in zip(*parts, strict=True))
            distinct, word = np.unique(words, return_inverse=True)
            endings = np.zeros(len(distinct), np.uint16)
            endings[word] = ends
            row = (
                chunk,
                pack_even(ids),
                pack_even(missing),
                pack_even(trained),
                pack(counts),
                pack_even(word.astype(np.uint32)),
                pack(distinct.view(np.int64)),
                pack_even(endings),
            )
            types = [pa.int64(), *[pa.binary()] * 7]
            names = [x.split()[0] for x in _CHUNK.split(", ")]
            return pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, types, strict=True)], names)

        size = 0
        for batch in batches:
            for part in slices(batch, "text"):
                texts = read_texts(part.column("text"), lower=True)
                counts = texts.counts + 1
                ends = np.cumsum(counts) - 1
                is_word = np.ones(counts.sum(), bool)
                is_word[ends] = False
                words = np.full(len(is_word), _END)
                words[is_word] = texts.hashes()
                # The last two bytes of each word; a word of one byte has a blank before it.
                last = texts.data[texts.end - 1].astype(np.uint16)
                before = np.where(texts.end - texts.start > 1, texts.data[np.maximum(texts.end - 2, 0)], 0x20)
                own = np.zeros(len(is_word), np.uint16)
                own[is_word] = before.astype(np.uint16) << 8 | last
                held = np.asarray(part.column("held_out")).astype(bool)
                ids = part.column("doc_id")
                missing = np.asarray(ids.is_null()).astype(np.uint8)
                parts.append((words, own, (~held).astype(np.uint8), counts, np.asarray(ids.fill_null(0)).astype(np.int64), missing))
                size += len(words)
                if size >= limit:
                    yield close()
                    parts.clear()
                    size, chunk = 0, chunk + 1
        if parts:
            yield close()

    return run


def _pairs(tokens: bytes, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct (word, preceding word) of a chunk, ascending, and the pair of every token."""
    word = unpack_even(tokens, np.uint32).astype(np.int64)
    # Every text closes with the end token, which so precedes the first word of the next one.
    return np.unique(word << 32 | np.concatenate([np.searchsorted(words, [_END]), word[:-1]]), return_inverse=True)


def _cut(buckets: int):
    """The pairs of every chunk, one row for each bucket of words."""
    names = [x.split()[0] for x in _PIECE.split(", ")]
    types = [pa.int64(), pa.int32(), *[pa.binary()] * 6]

    def piece(row: dict) -> pa.RecordBatch:
        words, endings = unpack(row["words"]).view(np.uint64), unpack_even(row["endings"], np.uint16)
        pairs, pair = _pairs(row["tokens"], words)
        trained = np.repeat(unpack_even(row["trained"], np.uint8) == 1, unpack(row["counts"]))
        seen = np.bincount(pair[trained], minlength=len(pairs))
        place = ((words >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
        word = pairs >> 32
        # Words ascend, so each bucket is one slice of the words and of the pairs.
        edges = np.searchsorted(place, np.arange(buckets + 1))
        rows = []
        for b in np.flatnonzero(np.diff(edges)).tolist():
            w0, w1 = edges[b], edges[b + 1]
            p0, p1 = np.searchsorted(word, [w0, w1])
            leaves, leaf = np.unique(pairs[p0:p1] & 0xFFFFFFFF, return_inverse=True)
            rows.append(
                (
                    row["chunk"],
                    b,
                    pack(words[w0:w1].view(np.int64)),
                    pack(word[p0:p1] - w0),
                    pack_even(leaf.astype(np.uint32)),
                    pack_even(seen[p0:p1]),
                    pack(words[leaves].view(np.int64)),
                    pack_even(endings[leaves]),
                )
            )
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield piece(batch.slice(i, 1).to_pylist()[0])

    return run


def _one_row(group: pd.DataFrame) -> pd.DataFrame:
    """A bucket with its training counts over all chunks, and what each chunk asks for."""
    group = group.sort_values("chunk")
    # Words and contexts of the chunks first, so that pairs are numbers throughout.
    words = [unpack(x).view(np.uint64) for x in group["words"]]
    leaves = [unpack(x).view(np.uint64) for x in group["leaves"]]
    word_at, leaf_at = (np.cumsum([0, *map(len, x)]) for x in (words, leaves))
    word = np.unique(np.concatenate(words), return_inverse=True)[1]
    leaf, first, place = np.unique(np.concatenate(leaves), return_index=True, return_inverse=True)
    endings = np.concatenate([unpack_even(x, np.uint16) for x in group["endings"]])[first]
    keys, seen = [], []
    for i, row in enumerate(group.itertuples()):
        own = word[word_at[i] : word_at[i + 1]][unpack(row.pairs)] << 32
        own |= place[leaf_at[i] : leaf_at[i + 1]][unpack_even(row.contexts, np.uint32)]
        keys.append(own)
        seen.append(unpack_even(row.counts, np.int64))
    lengths = np.array([len(x) for x in keys])
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    fresh = np.concatenate([[True], keys[1:] != keys[:-1]])
    asked = np.empty(len(keys), np.uint32)
    asked[order] = np.cumsum(fresh, dtype=np.int64) - 1
    pairs = keys[fresh]
    seen = np.add.reduceat(np.concatenate(seen)[order], np.flatnonzero(fresh))
    return pd.DataFrame(
        {
            "bucket": group["bucket"].iloc[:1],
            "chunks": [pack(group["chunk"].to_numpy(np.int64))],
            "lengths": [pack(lengths)],
            "asked": [pack_even(asked)],
            "word": [pack(pairs >> 32)],
            "context": [pack_even((pairs & 0xFFFFFFFF).astype(np.uint32))],
            "seen": [pack_even(seen)],
            "leaves": [pack(leaf.view(np.int64))],
            "endings": [pack_even(endings)],
        }
    )


_BUCKET = "bucket int, chunks binary, lengths binary, asked binary, word binary, context binary, seen binary, leaves binary, endings binary"
_SUMS = "level int, place int, customers long, tables long, once long, twice long, slot int, bucket int, leaves binary, served binary, laid binary"


@dataclass(frozen=True)
class Totals:
    """Customers and tables of every restaurant by level (0: root), discounts, tokens, known words.

    Level 2 holds the restaurants of one bucket, in its order, and is empty until `with_leaves`.
    """

    customers: tuple[np.ndarray, ...]
    tables: tuple[np.ndarray, ...]
    discounts: np.ndarray
    tokens: int
    known: int

    def with_leaves(self, rows: pd.DataFrame) -> Totals:
        rows = rows.sort_values("slot")
        served, laid = (np.concatenate([unpack_even(x, np.int64) for x in rows[n]]) for n in ("served", "laid"))
        return replace(self, customers=(*self.customers[:2], served), tables=(*self.tables[:2], laid))


class Seating:
    """The words of one bucket: pairs with contexts, the endings above them (else the last byte), their roots."""

    def __init__(self, word: np.ndarray, context: np.ndarray, seen: np.ndarray, ending: np.ndarray | None = None):
        self.seen = seen
        middle = word << 16 | (context & 0xFF if ending is None else ending)
        keys, self.up2 = np.unique(middle, return_inverse=True)
        roots, self.up1 = np.unique(keys >> 16, return_inverse=True)
        self.contexts = (np.zeros(len(roots), np.int64), keys & 0xFFFF, context)
        # Least seating: one table per word and restaurant.
        self.tables = [np.zeros(0), np.zeros(0), (seen > 0).astype(np.int64)]
        for level in (1, 0):
            self.tables[level] = (self.customers(level) > 0).astype(np.int64)

    def customers(self, level: int) -> np.ndarray:
        if level == 2:
            return self.seen
        up, size = (self.up2, len(self.contexts[1])) if level == 1 else (self.up1, len(self.contexts[0]))
        return np.bincount(up, weights=self.tables[level + 1], minlength=size).astype(np.int64)

    def rates(self, level: int, totals: Totals) -> tuple[np.ndarray, np.ndarray]:
        """Weight of a new table and size of the restaurant, for every entry of a level."""
        at = self.contexts[level]
        return STRENGTH + totals.discounts[level] * totals.tables[level][at], STRENGTH + totals.customers[level][at]

    def predict(self, totals: Totals) -> list[np.ndarray]:
        out: list[np.ndarray] = []
        for level, up in ((0, None), (1, self.up1), (2, self.up2)):
            parent = 1 / (totals.known + 1) if up is None else out[-1][up]
            fresh, size = self.rates(level, totals)
            own = np.maximum(self.customers(level) - totals.discounts[level] * self.tables[level], 0)
            out.append((own + fresh * parent) / size)
        return out

    def sweep(self, totals: Totals, rng: np.random.Generator) -> None:
        """Seats every word of every restaurant anew, from the leaves to the root."""
        for level, up in ((2, self.up2), (1, self.up1), (0, None)):
            parent = 1 / (totals.known + 1)
            if up is not None:
                parent = self.without_own(level, up, totals)
            weight = self.rates(level, totals)[0] * parent
            self.tables[level] = seat(self.customers(level), weight, totals.discounts[level], rng)

    def without_own(self, level: int, up: np.ndarray, totals: Totals) -> np.ndarray:
        """The parent's predictive probability without the customers that the entry itself has sent there."""
        above = level - 1
        others = np.maximum(self.customers(above)[up] - self.tables[level], 0)
        tables = np.minimum(self.tables[above][up], others)
        fresh, size = (x[up] for x in self.rates(above, totals))
        grand = self.predict(totals)[above - 1][self.up1][up] if above else 1 / (totals.known + 1)
        return (np.maximum(others - totals.discounts[above] * tables, 0) + fresh * grand) / size


def seat(customers: np.ndarray, weight: np.ndarray, discount: float, rng: np.random.Generator) -> np.ndarray:
    """Tables after seating that many customers of one word; the first one always opens a table."""
    tables = (customers > 0).astype(np.int64)
    weight = np.broadcast_to(weight, customers.shape)
    active = np.flatnonzero(customers > 1)
    sat = 1
    while len(active):
        step = 1 if sat < ONE_BY_ONE else sat
        block = np.minimum(step, customers[active] - sat)
        rate = weight[active] / (np.maximum(sat + (block - 1) / 2 - discount * tables[active], 1e-9) + weight[active])
        opened = rng.random(len(active)) < rate if step == 1 else np.minimum(rng.poisson(block * rate), block)
        tables[active] += opened
        sat += step
        active = active[customers[active] > sat]
    return tables


def _state(row) -> Seating:
    context = unpack_even(row["context"], np.uint32).astype(np.int64)
    ending = unpack_even(row["endings"], np.uint16).astype(np.int64)[context]
    return Seating(unpack(row["word"]), context, unpack_even(row["seen"], np.int64), ending)


def _sums(state: Seating, row, slots: int) -> pd.DataFrame:
    """What one bucket adds to the restaurants: levels 0 and 1 by place, 2 in one row, and in rows of level 3 the
    restaurants of whole words, by slots of their hashes."""
    names = [x.split()[0] for x in _SUMS.split(", ")]
    out = []
    for level, size in ((0, 1), (1, 65536), (2, 1)):
        c = state.customers(level)
        at = state.contexts[level] if level < 2 else np.zeros(len(c), np.int64)
        values = [np.bincount(at, weights=w, minlength=size) for w in (c, state.tables[level], c == 1, c == 2)]
        used = np.flatnonzero(values[0])
        frame = pd.DataFrame({"level": level, "place": used} | {n: v[used].astype(np.int64) for n, v in zip(names[2:6], values)})
        out.append(frame.assign(slot=0, bucket=0, leaves=b"", served=b"", laid=b""))
    leaves = unpack(row["leaves"]).view(np.uint64)
    served, laid = (
        np.bincount(state.contexts[2], weights=w, minlength=len(leaves)).astype(np.int64) for w in (state.seen, state.tables[2])
    )
    slot = ((leaves >> np.uint64(32)) * np.uint64(slots) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(slot, np.arange(slots + 1))
    rows = [
        (3, 0, 0, 0, 0, 0, k, row["bucket"], pack(leaves[i:j].view(np.int64)), pack_even(served[i:j]), pack_even(laid[i:j]))
        for k, (i, j) in enumerate(zip(edges[:-1], edges[1:], strict=True))
        if i < j
    ]
    return pd.concat([*out, pd.DataFrame(rows, columns=names)])[names]


def _leaf_totals(group: pd.DataFrame) -> pd.DataFrame:
    """One slot: the sums over all buckets, for each bucket in the order of its restaurants."""
    leaves = [unpack(x).view(np.uint64) for x in group["leaves"]]
    distinct, at = np.unique(np.concatenate(leaves), return_inverse=True)
    cuts = np.cumsum([len(x) for x in leaves])[:-1]
    out = group[["bucket", "slot"]].copy()
    for name in ("served", "laid"):
        values = np.concatenate([unpack_even(x, np.int64) for x in group[name]])
        values = np.bincount(at, weights=values, minlength=len(distinct)).astype(np.int64)[at]
        out[name] = [pack_even(x) for x in np.split(values, cuts)]
    return out


def _totals(
    buckets: DataFrame, before: tuple[Totals, DataFrame, str] | None, sweep: int, slots: int
) -> tuple[Totals, DataFrame, str]:
    """Sums over all buckets, after a number of sweeps with the totals `before` (none: least seating), and where
    those of the preceding words lie. The ones of `before` are deleted."""
    states = buckets.select("bucket", "word", "context", "seen", "leaves", "endings")

    def least(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for _, row in batch.iterrows():
                yield _sums(_state(row), row, slots)

    if before is None:
        rows = states.mapInPandas(least, _SUMS)
    else:
        shared, leaves, _ = before

        def seated(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
            row, totals = group.iloc[0], shared.with_leaves(own)
            state, rng = _state(row), np.random.default_rng([sweep, int(row["bucket"])])
            for _ in range(2):
                state.sweep(totals, rng)
            return _sums(state, row, slots)

        rows = states.groupBy("bucket").cogroup(leaves.groupBy("bucket")).applyInPandas(seated, _SUMS)
    # Written, as it feeds both kinds of totals.
    rows, place = stored_at(rows, "sums")
    numbers = ["customers", "tables", "once", "twice"]
    upper = (
        rows.filter("level < 3")
        .groupBy("level", "place")
        .agg(*[F.sum(n).alias(n) for n in numbers])
        .toArrow()  # at most one row per ending, 65,538 of them
        .to_pandas()
    )
    leaves, totals_place = stored_at(
        rows.filter("level = 3").groupBy("slot").applyInPandas(_leaf_totals, "bucket int, slot int, served binary, laid binary"), "leaf-totals"
    )
    # Nothing reads the sums any more, nor the totals they were sampled with.
    for old in (place, before[2] if before else None):
        if old is not None:
            discard(buckets.sparkSession, old)
    customers, tables, discounts = [], [], []
    for level, size in ((0, 1), (1, 65536), (2, 1)):
        own = upper[upper["level"] == level]
        for out, name in ((customers, "customers"), (tables, "tables")):
            values = np.zeros(size)
            values[own["place"]] = own[name]
            out.append(values)
        once, twice = own["once"].sum(), own["twice"].sum()
        discounts.append(float(np.clip(once / max(once + 2 * twice, 1), 0.1, 0.9)))
    known = int(tables[0].sum()) if before is None else before[0].known
    none = np.zeros(0)
    return Totals((*customers[:2], none), (*tables[:2], none), np.array(discounts), int(customers[2].sum()), known), leaves, totals_place


def _answers(shared: Totals):
    def run(group: pd.DataFrame, own: pd.DataFrame) -> pd.DataFrame:
        row, totals = group.iloc[0], shared.with_leaves(own)
        state = _state(row)
        word = unpack(row["word"])
        count = np.bincount(word, weights=state.seen).astype(np.int64)[word]
        rng = np.random.default_rng([BURN_IN, int(row["bucket"])])
        mean = np.zeros(len(word))
        state.sweep(totals, rng)
        for _ in range(SAMPLES):
            state.sweep(totals, rng)
            mean += state.predict(totals)[2] / SAMPLES
        asked = unpack_even(row["asked"], np.uint32)
        logs, counts = np.log10(mean)[asked].astype(np.float32), count[asked]
        cuts = np.cumsum(unpack(row["lengths"]))[:-1]
        return pd.DataFrame(
            {
                "chunk": unpack(row["chunks"]),
                "bucket": row["bucket"],
                "logs": [pack_even(x) for x in np.split(logs, cuts)],
                "seen": [pack_even(x) for x in np.split(counts, cuts)],
            }
        )

    return run


def _document_scores(totals: Totals):
    def run(chunks: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        answers = answers.sort_values("bucket")
        logs = np.concatenate([unpack_even(x, np.float32) for x in answers["logs"]]).astype(np.float64)
        seen = np.concatenate([unpack_even(x, np.int64) for x in answers["seen"]])
        base = np.log10((seen + 1) / (totals.tokens + totals.known + 1))
        row = chunks.iloc[0]
        pair, counts = _pairs(row["tokens"], unpack(row["words"]).view(np.uint64))[1], unpack(row["counts"])
        starts = np.cumsum(counts) - counts
        ids = pd.array(unpack_even(row["ids"], np.int64), "Int64")
        ids[unpack_even(row["missing"], np.uint8) == 1] = pd.NA
        return pd.DataFrame(
            {
                "doc_id": ids,
                "n_tokens": counts,
                "n_known": np.add.reduceat((seen > 0)[pair].astype(np.int64), starts),
                "base_score": np.add.reduceat(base[pair], starts),
                "score": np.add.reduceat(logs[pair], starts),
            }
        )

    return run


def scored(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", folds: int = 7, held: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for every row of `docs`.

    Rows whose id's crc32 modulo `folds` is not `held` are learned from, all of them. A text is its words after A-Z
    is lower-cased and one end token; NULL and blank texts are the end token alone. Scores are log10 probabilities.
    Repeated rows are learned from and scored each; a NULL identifier has remainder 0. Without training rows the
    base is uniform over one unknown word. An empty table gives an empty result; other columns of `docs` may have
    any name. Perplexity is `10 ** (-score / n_tokens)`.
    """
    plain = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (remainder(F.col(doc_id), folds) == held).alias("held_out"),
        F.col(text).alias("text"),
    )
    # About one word for six bytes; only the size of buckets depends on it.
    size = plain.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = max(1, size // 6 // BUCKET_TOKENS)
    chunks = stored(plain.mapInArrow(_pack_chunks(CHUNK_TOKENS), _CHUNK), "chunks")
    # Cut from the stored chunks, so that a repeated task numbers their pairs alike; only the shuffle holds the pieces.
    buckets = dealt(
        chunks.mapInArrow(_cut(count), _PIECE).groupBy("bucket").applyInPandas(_one_row, _BUCKET), "buckets", "bucket", count
    )
    found = _totals(buckets, None, 0, count)
    for sweep in range(BURN_IN):
        found = _totals(buckets, found, sweep, count)
    totals, leaves, _ = found
    answers = (
        buckets.groupBy("bucket")
        .cogroup(leaves.groupBy("bucket"))
        .applyInPandas(_answers(totals), "chunk long, bucket int, logs binary, seen binary")
    )
    asking = chunks.select("chunk", "ids", "missing", "counts", "tokens", "words")
    scores = (
        asking.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInPandas(_document_scores(totals), _SCORES)
    )
    return scores.select(
        "doc_id",
        (remainder(F.col("doc_id"), folds) == held).alias("held_out"),
        "n_tokens",
        "n_known",
        F.lit(totals.tokens).cast("long").alias("train_tokens"),
        "base_score",
        "score",
    )
