"""Removal of passages that an earlier document has too, found through fixed-block anchors.

Any window of WINDOW words contains one whole block of BLOCK words that starts at a multiple of BLOCK in the
document the window is read from. So it is enough to index these non-overlapping blocks and to probe
them with every rolling window of BLOCK words of every document:

1. Probes travel to the bucket of their hash, packed. Those that start at a multiple of BLOCK are the
   index. A probe whose hash is indexed for a smaller document is a hit, and it and the blocks it hit are
   anchors.
2. Every WINDOW-word window around an anchor, on both sides, is compared with the windows of all other
   documents through two independent 64-bit hashes of all its words, 128 bits; the windows found in a smaller document extend the
   hit to the maximal repeat, whichever document each part of it comes from.

Both steps pre-aggregate: what a task's own documents decide among each other is not sent, so a copy that
is frequent is sent once per task and not once per document. Hits are rare (one per block of a repeat), and only
documents with anchors are read again.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.packed import pack, unpack
from habispark.llm.tables import stored, unused
from habispark.llm.words import Texts, mix, read_texts, slices

WINDOW = 50
BLOCK = WINDOW // 2
# Probes a task gathers before it sends them on, and about as many entries per bucket.
GATHERED = 1_000_000
# Bits of the filter that keeps most documents without anchors out of a shuffle: 1 MB, whatever the input.
FILTER_BITS = 1 << 23
_SENT = "bucket int, here boolean, keys binary, ids binary, places binary"
_SPOTS = "doc_id long, spots array<long>"


def joined(texts: Texts, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kept words of all texts with one space after each, and where each text begins."""
    start, length = texts.start[keep], texts.end[keep] - texts.start[keep] + 1
    to = np.cumsum(length)
    source = np.repeat(start - (to - length), length) + np.arange(to[-1] if len(to) else 0)
    padded = np.append(texts.data, np.uint8(0x20))
    out = padded[source]
    out[to - 1] = 0x20
    kept = np.concatenate([[0], np.cumsum(keep)])[texts.first]
    return out, np.concatenate([[0], to])[kept]


def _texts_of(data: np.ndarray, first: np.ndarray) -> list[bytes]:
    return [data[a : max(a, b - 1)].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = read_texts(part.column("text"))
            words = _texts_of(*joined(texts, np.ones(len(texts.start), bool)))
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    pa.array(texts.counts.astype(np.int64)),
                    pa.array([hashlib.sha256(x).hexdigest() for x in words]),
                ],
                ["doc_id", "n_words", "sha256"],
            )


def _spots(ids: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, pa.Array]:
    """One entry per document, with its distinct places in order."""
    order = np.lexsort((places, ids))
    ids, places = ids[order], places[order]
    fresh = np.ones(len(ids), bool)
    fresh[1:] = (ids[1:] != ids[:-1]) | (places[1:] != places[:-1])
    ids, places = ids[fresh], places[fresh]
    at = np.flatnonzero(np.concatenate([[True], ids[1:] != ids[:-1]])) if len(ids) else np.zeros(0, int)
    lists = pa.ListArray.from_arrays(pa.array(np.append(at, len(ids)).astype(np.int32)), pa.array(places))
    return ids[at], lists


def _decided(keys: np.ndarray, ids: np.ndarray, source: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: has a `source` entry with this key a smaller id; and that smallest source id's own entries. A key is
    one number, or a row of two."""
    parts = keys.reshape(len(keys), -1 if len(keys) else 1).T
    order = np.lexsort((ids, *parts))
    k = parts[:, order]
    new = np.ones(len(keys), bool)
    new[1:] = (k[:, 1:] != k[:, :-1]).any(axis=0)
    group = np.cumsum(new) - 1
    top = np.iinfo(np.int64).max
    lowest = np.minimum.reduceat(np.where(source[order], ids[order], top), np.flatnonzero(new)) if len(keys) else ids[:0]
    beaten, best = np.zeros(len(keys), bool), np.zeros(len(keys), bool)
    beaten[order] = ids[order] > lowest[group]
    best[order] = ids[order] == lowest[group]
    return beaten, best


def _ranges(ordered: np.ndarray) -> list[tuple[int, int]]:
    """Where each run of equal values begins and ends."""
    if not len(ordered):
        return []
    cuts = [0, *(np.flatnonzero(ordered[1:] != ordered[:-1]) + 1).tolist(), len(ordered)]
    return list(zip(cuts[:-1], cuts[1:], strict=True))


def _send(keys: np.ndarray, ids: np.ndarray, places: np.ndarray, buckets: int, wide: bool) -> Iterator[pa.RecordBatch]:
    """Entries packed per bucket. Wide keys are rows of two numbers; narrow ones keep the 32 bits that the bucket does not tell."""
    bucket = (((keys[:, 0] if wide else keys) >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)).astype(np.int64)
    order = np.argsort(bucket, kind="stable")
    bucket, keys, ids, places = bucket[order], keys[order], ids[order], places[order]
    rows = [
        (
            int(bucket[a]),
            False,
            (keys[a:b] if wide else keys[a:b].astype(np.uint32)).tobytes(),
            pack(ids[a:b]),
            pack(places[a:b]),
        )
        for a, b in _ranges(bucket)
    ]
    yield _sent(rows)


def _sent(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * 5
    types = [pa.int32(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    names = ["bucket", "here", "keys", "ids", "places"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def _here(ids: np.ndarray, places: np.ndarray, buckets: int) -> pa.RecordBatch:
    """What a task has decided itself, passed on through any bucket."""
    from pyspark import TaskContext

    order = np.lexsort((places, ids))
    return _sent([(TaskContext.get().partitionId() % buckets, True, b"", pack(ids[order]), pack(places[order]))])


def _gathered(batches, windows_of) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Keys, ids and places of the windows of many texts at a time."""
    parts, size = [], 0
    for batch in batches:
        for part in slices(batch, "text"):
            found = windows_of(part, read_texts(part.column("text")))
            parts.append(found)
            size += len(found[0])
            if size >= GATHERED:
                yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))
                parts, size = [], 0
    if parts:
        yield tuple(np.concatenate(x) for x in zip(*parts, strict=True))


def _probes(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows_of(part: pa.RecordBatch, texts: Texts):
            at, keys = texts.windows(texts.hashes(), BLOCK)
            owner = texts.owner()[at]
            long_enough = texts.counts[owner] >= WINDOW
            at, keys, owner = at[long_enough], keys[long_enough], owner[long_enough]
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            return keys, ids[owner], at - texts.first[owner]

        for keys, ids, places in _gathered(batches, windows_of):
            block = places % BLOCK == 0
            beaten, best = _decided(keys, ids, block)
            # The blocks that beat others here are anchors as well.
            order = np.argsort(keys[beaten], kind="stable")
            hit = keys[beaten][order]
            beats = best & block & _member(keys, hit)
            yield _here(ids[beaten | beats], places[beaten | beats], buckets)
            left = ~beaten
            yield from _send(keys[left], ids[left], places[left], buckets, wide=False)

    return run


def _member(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    at = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[at] == values


def _received(group: pd.DataFrame, kind: type) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    here = group[group["here"]]
    sent = group[~group["here"]]
    join = lambda xs, t: np.concatenate(xs) if len(xs) else np.zeros(0, t)
    return (
        join([np.frombuffer(x, kind) for x in sent["keys"]], kind),
        join([unpack(x) for x in sent["ids"]], np.int64),
        join([unpack(x) for x in sent["places"]], np.int64),
        join([unpack(x) for x in here["ids"]], np.int64),
        join([unpack(x) for x in here["places"]], np.int64),
    )


def _routed(ids: np.ndarray, places: np.ndarray, buckets: int) -> pd.DataFrame:
    """Findings packed for the task that gathers them by document."""
    owner = (mix(ids.view(np.uint64)) % np.uint64(buckets)).astype(np.int32)
    order = np.lexsort((places, ids, owner))
    owner, ids, places = owner[order], ids[order], places[order]
    ranges = _ranges(owner)
    return pd.DataFrame(
        {
            "owner": owner[[a for a, _ in ranges]],
            "ids": [pack(ids[a:b]) for a, b in ranges],
            "places": [pack(places[a:b]) for a, b in ranges],
        }
    )


def _anchors(buckets: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, ids, places, ids_here, places_here = _received(group, np.uint32)
        block = places % BLOCK == 0
        beaten, _ = _decided(keys, ids, block)
        anchor = beaten | (block & _member(keys, np.sort(keys[beaten])))
        return _routed(np.concatenate([ids[anchor], ids_here]), np.concatenate([places[anchor], places_here]), buckets)

    return run


def _covers(buckets: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        keys, ids, places, ids_here, places_here = _received(group, np.uint64)
        keys = keys.reshape(-1, 2)
        beaten, _ = _decided(keys, ids, np.ones(len(ids), bool))
        return _routed(np.concatenate([ids[beaten], ids_here]), np.concatenate([places[beaten], places_here]), buckets)

    return run


def _listed(group: pd.DataFrame) -> pd.DataFrame:
    owners, lists = _spots(
        np.concatenate([unpack(x) for x in group["ids"]]), np.concatenate([unpack(x) for x in group["places"]])
    )
    return pd.DataFrame({"doc_id": owners, "spots": lists.to_pandas()})


def _gathered_spots(sent: DataFrame, decide) -> DataFrame:
    """doc_id and its spots: decided per bucket of window hashes, gathered per bucket of documents."""
    return (
        sent.groupBy("bucket")
        .applyInPandas(decide, "owner int, ids binary, places binary")
        .groupBy("owner")
        .applyInPandas(_listed, _SPOTS)
    )


def _tags(texts: Texts) -> np.ndarray:
    """31 bits of every text that tell rows of one identifier apart, above those of a place."""
    return (texts.hash_spans(texts.offsets[:-1], texts.offsets[1:]) >> np.uint64(33)).astype(np.int64) << 32


def _listed_places(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The places of all lists and the number of the text of each."""
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    counts = np.asarray(lists.value_lengths().fill_null(0))
    return lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64), np.repeat(np.arange(len(counts)), counts)


def _marked(texts: Texts, places: np.ndarray, owner: np.ndarray, before: int, after: int) -> np.ndarray:
    """Words from `before` places ahead of a listed one to `after` behind it (exclusive), within their text."""
    base, limit = texts.first[owner], texts.first[owner + 1]
    steps = np.zeros(len(texts.start) + 1, np.int64)
    np.add.at(steps, np.minimum(np.maximum(base + places - before, base), limit), 1)
    np.add.at(steps, np.minimum(base + places + after, limit), -1)
    return np.cumsum(steps)[:-1] > 0


def _windows(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def windows_of(part: pa.RecordBatch, texts: Texts):
            at, keys = texts.windows(texts.hashes(), WINDOW)
            near = _marked(texts, *_listed_places(part.column("spots")), WINDOW - BLOCK, 1)[at]
            keys = np.stack([keys[near], texts.windows(texts.other_hashes(), WINDOW)[1][near]], axis=1)
            at = at[near]
            owner = texts.owner()[at]
            ids = part.column("doc_id").to_numpy(zero_copy_only=False).astype(np.int64)
            return keys, ids[owner], at - texts.first[owner] + _tags(texts)[owner]

        for keys, ids, places in _gathered(batches, windows_of):
            beaten, _ = _decided(keys, ids, np.ones(len(ids), bool))
            yield _here(ids[beaten], places[beaten], buckets)
            left = ~beaten
            yield from _send(keys[left], ids[left], places[left], buckets, wide=True)

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "text"):
            texts = read_texts(part.column("text"))
            places, owner = _listed_places(part.column("spots"))
            own = places >> 32 << 32 == _tags(texts)[owner]
            gone = _marked(texts, places[own] & 0xFFFFFFFF, owner[own], 0, WINDOW)
            removed = np.concatenate([[0], np.cumsum(gone)])
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id"),
                    part.column("text"),
                    pa.array((removed[texts.first[1:]] - removed[texts.first[:-1]]).astype(np.int64)),
                    pa.array([x.decode() for x in _texts_of(*joined(texts, ~gone))]),
                ],
                ["doc_id", "text", "n_removed", "kept_text"],
            )


def _place(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("long")), F.lit(FILTER_BITS))


def _sieve(ids: DataFrame) -> Broadcast:
    """A filter of fixed size for the doc_id of `ids`: FILTER_BITS bits."""
    words = (
        ids.select(_place(F.col("doc_id")).alias("bit"))
        .groupBy(F.expr("bit div 64").alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(bit % 64 as int)))").alias("bits"))
        .toArrow()  # at most FILTER_BITS / 64 rows
    )
    table = np.zeros(FILTER_BITS // 64, np.int64)
    table[words["word"].to_numpy()] = words["bits"].to_numpy()
    return ids.sparkSession.sparkContext.broadcast(table)


def _sifted(docs: DataFrame, doc_id: str, sieve: Broadcast, among: bool = True) -> DataFrame:
    """The rows whose id may be among those of the sieve, or those whose id is not: exact on one side, so that the join
    that follows decides and this only spares it rows."""
    bit_at = len(docs.columns)

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sieve.value.view(np.uint64)
        for batch in batches:
            bit = batch.column(bit_at).to_numpy(zero_copy_only=False)
            found = (known[bit >> 6] >> (bit & 63).astype(np.uint64) & np.uint64(1)).astype(bool)
            yield batch.select(list(range(bit_at))).filter(pa.array(found == among))

    bit = unused("bit", docs.columns)
    return docs.select("*", _place(F.col(doc_id)).alias(bit)).mapInArrow(keep, docs.schema)


def repeats_cut(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """Two frames: doc_id, n_words, sha256 of every row of `docs`; and doc_id, text, n_removed, kept_text of the
    rows that lose words.

    A word goes if a window of WINDOW words that covers it also occurs in a document with a smaller id;
    kept words are joined by one space. Windows are judged on the input. NULL and blank texts have no
    words. Rows with a NULL identifier neither lose words nor take any; rows that repeat an identifier
    do not take words from each other, and each loses what its own text repeats. An empty table gives empty frames.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    summary = stored(plain.mapInArrow(_summaries, "doc_id long, n_words long, sha256 string"), "summaries")
    words = summary.agg(F.sum("n_words")).first()[0] or 0
    buckets = max(1, words // GATHERED)
    named = plain.filter(F.col("doc_id").isNotNull())
    anchors = stored(_gathered_spots(named.mapInArrow(_probes(buckets), _SENT), _anchors(buckets)), "anchors")
    anchored = stored(_sifted(named, "doc_id", _sieve(anchors)).join(anchors, "doc_id"), "anchored")
    covers = _gathered_spots(anchored.mapInArrow(_windows(buckets), _SENT), _covers(buckets))
    changed = anchored.drop("spots").join(covers, "doc_id").mapInArrow(
        _cut, "doc_id long, text string, n_removed long, kept_text string"
    )
    return summary, changed


def removed_words(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 for every row of `docs`; see `repeats_cut`."""
    summary, changed = repeats_cut(docs, doc_id, text)
    # Rows that repeat an identifier are told apart by their words.
    cut = changed.select(
        F.col("doc_id").alias("changed_id"),
        "n_removed",
        F.sha2("kept_text", 256).alias("changed_sha256"),
        F.col("text").alias("changed_text"),
    )
    cut = cut.withColumn("words", F.sha2(_spaced(F.col("changed_text")), 256)).drop("changed_text").distinct()
    return summary.join(
        cut, (F.col("doc_id") == F.col("changed_id")) & (F.col("sha256") == F.col("words")), "left"
    ).select(
        "doc_id",
        "n_words",
        F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("changed_sha256", "sha256").alias("kept_sha256"),
    )


def _spaced(text):
    """Words joined by one space."""
    return F.trim(F.regexp_replace(text, "[\\x20\\x09-\\x0D]+", " "))


def without_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """`docs` with repeated passages taken out of `text`; other texts and all other columns stay as they are.

    Rows whose id may belong to a changed text are joined with the changes, by id and digest of the text; all others pass by
    without a shuffle. NULL texts and identifiers, repeated rows and empty tables are as in `repeats_cut`.
    """
    _, changed = repeats_cut(docs, doc_id, text)
    cut = changed.select("doc_id", F.sha2("text", 256).alias("old"), F.col("kept_text").alias("new")).distinct()
    cut = stored(cut, "cut")
    key, old, new = (unused(name, docs.columns) for name in ("changed_id", "old_sha256", "new_text"))
    own = unused("own_sha256", docs.columns)
    sieve = _sieve(cut)
    likely = _sifted(docs, doc_id, sieve).select("*", F.sha2(F.col(text), 256).alias(own))
    same = (F.col(doc_id) == F.col(key)) & (F.col(own) == F.col(old))
    mended = likely.join(cut.toDF(key, old, new), same, "left").select(
        *[F.coalesce(new, text).alias(text) if c == text else F.col(c) for c in docs.columns]
    )
    return _sifted(docs, doc_id, sieve, among=False).union(mended)
