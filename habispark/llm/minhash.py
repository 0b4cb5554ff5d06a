"""Near-duplicate detection with circulant MinHash, banding and exact verification.

A document is the set of its distinct five-word shingles. The first permutation scatters the 64-bit
shingle hashes over SLOTS places; the second, a random permutation of these places, is shifted
circularly by one place per coordinate, so the coordinate k of a signature is the smallest
`second[(first(s) + k) mod SLOTS]`. All coordinates of a shingle are one contiguous slice.

Signatures only propose pairs. What is linked is decided on the full shingle sets.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.components import connected_components
from habispark.llm.tables import stored, without_rows
from habispark.llm.words import Texts, mix, read_texts, slices

SHINGLE = 5
THRESHOLD = 85
# A pair at exactly the threshold shares no band with at most this probability.
MISSED = 1e-6
# Coordinates a signature may have; 36 bands of 7 at 85 %, 46 bands of 6 at 80 %.
COORDINATES = 280
SLOTS = 1 << 20
# Classes of shingles in the bound of the last comparison.
COMMON_CLASSES, RARE_CLASSES, COMMON_FROM = 8, 24, 32
_BLOCK = 4096
_SIGNED = "doc_id long, text_hash long, n_shingles long, set_key binary, bands array<long>"


def banding(threshold: int) -> tuple[int, int]:
    """Bands and rows: the longest bands with which a signature of at most COORDINATES misses at most MISSED."""
    found = None
    for rows in range(1, COORDINATES + 1):
        agree = (threshold / 100) ** rows
        bands = math.ceil(math.log(MISSED) / math.log1p(-agree)) if agree < 1 else 1
        if bands * rows <= COORDINATES:
            found = bands, rows
    if found is None:
        raise ValueError(f"no signature of {COORDINATES} coordinates finds pairs at {threshold} %")
    return found


def _second_permutation(coordinates: int = COORDINATES) -> np.ndarray:
    table = np.random.RandomState(7).permutation(SLOTS).astype(np.uint32)
    return np.lib.stride_tricks.sliding_window_view(np.concatenate([table, table[: coordinates - 1]]), coordinates)


def shingle_sets(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one text after another, and where each text begins."""
    words = texts.hashes()
    at, hashes = texts.windows(words, SHINGLE)
    owner = texts.owner()[at]
    short = np.flatnonzero((texts.counts > 0) & (texts.counts < SHINGLE))
    if len(short):
        whole = texts.first[short]
        # The one shingle of a short text: its words and how many they are.
        parts = np.zeros(len(short), np.uint64)
        for i in range(SHINGLE - 1):
            has = texts.counts[short] > i
            parts[has] = mix(parts[has] + words[whole[has] + i] + np.uint64(i + 1))
        owner = np.concatenate([owner, short])
        hashes = np.concatenate([hashes, parts])
    order = np.argsort(hashes, kind="stable")
    order = order[np.argsort(owner[order], kind="stable")]
    owner, hashes = owner[order], hashes[order]
    fresh = np.ones(len(hashes), bool)
    fresh[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
    owner, hashes = owner[fresh], hashes[fresh]
    return hashes, np.searchsorted(owner, np.arange(texts.count + 1))


def signatures(hashes: np.ndarray, first: np.ndarray, second: np.ndarray) -> np.ndarray:
    out = np.full((len(first) - 1, second.shape[1]), SLOTS, np.uint32)
    places = (mix(hashes) >> np.uint64(64 - 20)).astype(np.int64)
    for i, (a, b) in enumerate(zip(first[:-1], first[1:], strict=True)):
        for block in range(a, b, _BLOCK):
            np.minimum(out[i], second[places[block : min(b, block + _BLOCK)]].min(axis=0), out=out[i])
    return out


def _text_hash(text: str) -> Column:
    return F.xxhash64(F.col(text)).alias("text_hash")


def _sign(threshold: int):
    bands, rows = banding(threshold)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        second = _second_permutation(bands * rows)
        weights = mix(np.arange(1, rows + 1, dtype=np.uint64)) | np.uint64(1)
        salts = np.arange(bands, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for batch in batches:
            for part in slices(batch, "text"):
                texts = read_texts(part.column("text"), lower=True)
                hashes, first = shingle_sets(texts)
                sizes = np.diff(first)
                signature = signatures(hashes, first, second).astype(np.uint64).reshape(-1, bands, rows)
                keys_of_bands = mix((signature * weights).sum(axis=2, dtype=np.uint64) + salts)
                sums = np.zeros((2, len(hashes) + 1), np.uint64)
                np.cumsum(mix(hashes + np.uint64(1)), out=sums[0, 1:])
                np.cumsum(mix(hashes ^ np.uint64(0xA5A5A5A5A5A5A5A5)), out=sums[1, 1:])
                keys = np.ascontiguousarray((sums[:, first[1:]] - sums[:, first[:-1]]).T)
                empty = sizes == 0
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        part.column("text_hash"),
                        pa.array(sizes.astype(np.int64)),
                        pa.array([None if e else k.tobytes() for e, k in zip(empty, keys, strict=True)], pa.binary()),
                        pa.ListArray.from_arrays(
                            pa.array(np.concatenate([[0], np.cumsum(np.where(empty, 0, bands))]).astype(np.int32)),
                            pa.array(keys_of_bands[~empty].ravel().view(np.int64)),
                        ),
                    ],
                    ["doc_id", "text_hash", "n_shingles", "set_key", "bands"],
                )

    return run


def _verified(pairs: DataFrame, texts: DataFrame, threshold: int) -> DataFrame:
    """The pairs (a, b) with 100 * intersection >= threshold * union of their whole shingle sets."""
    left = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))
    right = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text_a"):
                a, first_a = shingle_sets(read_texts(part.column("text_a"), lower=True))
                b, first_b = shingle_sets(read_texts(part.column("text_b"), lower=True))
                row_a = np.repeat(np.arange(part.num_rows), np.diff(first_a))
                row_b = np.repeat(np.arange(part.num_rows), np.diff(first_b))
                row, value = np.concatenate([row_a, row_b]), np.concatenate([a, b])
                order = np.argsort(value, kind="stable")
                order = order[np.argsort(row[order], kind="stable")]
                row, value = row[order], value[order]
                both = row[1:][(row[1:] == row[:-1]) & (value[1:] == value[:-1])]
                common = np.bincount(both, minlength=part.num_rows)
                union = np.diff(first_a) + np.diff(first_b) - common
                keep = pa.array((union > 0) & (100 * common >= threshold * union))
                yield part.select(["a", "b"]).filter(keep)

    return pairs.join(left, "a").join(right, "b").mapInArrow(check, "a long, b long")


def _profiles(texts: DataFrame) -> DataFrame:
    """node, profile: how many shingles of a text that another of `texts` has as well fall into each class.

    Classes are fixed by the shingle alone, by how many texts hold it and by its hash, so the sum of the smaller
    counts of two texts over all classes is at least the size of their intersection.
    """

    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, first = shingle_sets(read_texts(part.column("text"), lower=True))
                ids = np.repeat(part.column("node").to_numpy(zero_copy_only=False), np.diff(first))
                yield pa.RecordBatch.from_arrays([pa.array(ids), pa.array(hashes.view(np.int64))], ["node", "shingle"])

    rows = stored(texts.mapInArrow(shingles, "node long, shingle long"), "split-shingles")
    held = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("holders")).filter(F.col("holders") > 1)
    common = F.pmod("shingle", F.lit(COMMON_CLASSES))
    rare = COMMON_CLASSES + F.pmod("shingle", F.lit(RARE_CLASSES))
    kind = F.when(F.col("holders") >= COMMON_FROM, common).otherwise(rare)
    counts = [F.count_if(F.col("kind") == i).cast("int") for i in range(COMMON_CLASSES + RARE_CLASSES)]
    return (
        rows.join(held, "shingle")
        .select("node", kind.alias("kind"))
        .groupBy("node")
        .agg(F.array(*counts).alias("profile"))
    )


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of `docs`.

    Words are `[^\\x20\\x09-\\x0D]+` after A-Z is lower-cased. A text with fewer than five words is one
    shingle; a text without words (or NULL) has none and is linked with nothing, so it stays. The
    component is named after its smallest identifier. Rows with a NULL identifier are linked with
    nothing, get a NULL component and stay; rows that repeat an identifier share its component. An empty table gives an
    empty result; other columns may have any name.

    Documents with equal sets are one class from the start and are never paired. In every band bucket all
    classes are compared with one leader, the class that shares most with others. Only classes that this
    leaves outside the bucket's main component are compared with the rest of their bucket, and only where an
    exact bound on the size of the intersection allows a link (`_profiles`). So the
    pairs of a large group of near copies are never written out, yet no pair that shares a bucket stays undecided
    unless both are in one component already.
    """
    return _judged(docs, doc_id, text, threshold, by_id=True).drop("text_hash")


def _judged(docs: DataFrame, doc_id: str, text: str, threshold: int, by_id: bool) -> DataFrame:
    """`near_duplicates` with the hash of each row's text; without `by_id` an identifier links none of its texts.

    Nodes are the classes of equal sets, by a hash of the set.
    """
    plain = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"), _text_hash(text))
    signed = stored(plain.mapInArrow(_sign(threshold), _SIGNED), "signatures")
    classes = stored(
        signed.filter(F.col("set_key").isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("set_key")
        .agg(F.min(F.struct("doc_id", "text_hash")).alias("first"))
        .select("set_key", F.xxhash64("set_key").alias("node"), F.col("first.doc_id").alias("rep"), F.col("first.text_hash").alias("rep_hash")),
        "classes",
    )
    members = signed.join(
        classes.withColumnRenamed("set_key", "class_key"),
        (F.col("doc_id") == F.col("rep")) & (F.col("text_hash") == F.col("rep_hash")) & (F.col("set_key") == F.col("class_key")),
    ).select("node", F.col("n_shingles").alias("n"), F.explode("bands").alias("band"))
    sizes = members.groupBy("band").agg(F.count(F.lit(1)).alias("size")).filter(F.col("size") > 1)
    shared = stored(members.join(sizes, "band"), "buckets")
    chosen = classes.join(shared.select("node").distinct(), "node").select("node", F.col("rep").alias("doc_id"), F.col("rep_hash").alias("text_hash"))
    texts = stored(plain.join(chosen, ["doc_id", "text_hash"]).select("node", "text").dropDuplicates(["node"]), "candidates")

    similar = 100 * F.least("n", "other_n") >= threshold * F.greatest("n", "other_n")

    def paired(one: str, other: str) -> list:
        return [F.least(one, other).alias("a"), F.greatest(one, other).alias("b")]

    weights = shared.groupBy("node").agg(F.sum("size").alias("weight"))
    leaders = (
        shared.join(weights, "node")
        .groupBy("band")
        .agg(F.max(F.struct("weight", F.bitwise_not("node").alias("order"), "n")).alias("top"))
        .select("band", F.bitwise_not("top.order").alias("leader"), F.col("top.n").alias("other_n"))
    )
    stars = stored(
        shared.join(leaders, "band")
        .filter((F.col("node") != F.col("leader")) & similar)
        .select(*paired("node", "leader"))
        .distinct(),
        "star-pairs",
    )
    links = stored(_verified(stars, texts, threshold), "links")
    if by_id:
        held = signed.join(classes, "set_key").select("doc_id", "node").distinct()
        several = held.groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("b")).filter("a < b").drop("b")
        again = held.join(several, "doc_id").filter("a <> node").select("a", F.col("node").alias("b"))
        links = stored(links.unionByName(again), "links")
    found = connected_components(links)

    placed = stored(
        shared.join(found, "node", "left").select(
            "band", "node", "n", F.coalesce("component", "node").alias("component")
        ),
        "placed",
    )
    main = (
        placed.groupBy("band", "component")
        .agg(F.count(F.lit(1)).alias("size"))
        .groupBy("band")
        .agg(F.max(F.struct("size", "component")).alias("top"), F.count(F.lit(1)).alias("components"))
        .filter(F.col("components") > 1)
        .select("band", F.col("top.component").alias("main"))
    )
    split = stored(placed.join(main, "band"), "split-buckets")
    profiles = _profiles(texts.join(split.select("node").distinct(), "node"))
    split = stored(split.join(profiles, "node"), "profiles")
    outside = split.filter(F.col("component") != F.col("main")).select(
        "band",
        F.col("node").alias("other"),
        F.col("n").alias("other_n"),
        F.col("profile").alias("other_profile"),
        F.col("component").alias("other_component"),
    )
    most = F.aggregate(F.zip_with("profile", "other_profile", lambda x, y: F.least(x, y)), F.lit(0), lambda x, y: x + y)
    possible = 100 * most >= threshold * (F.col("n") + F.col("other_n") - most)
    rest = (
        split.join(outside, "band")
        .filter((F.col("component") != F.col("other_component")) & similar & possible)
        .select(*paired("node", "other"))
        .distinct()
        .join(stars, ["a", "b"], "left_anti")
    )
    more = stored(_verified(rest, texts, threshold), "links")
    if not more.isEmpty():
        found = connected_components(links.unionByName(more))

    named = found.join(classes.select("node", "rep"), "node")
    names = named.groupBy("component").agg(F.min("rep").alias("name"))
    named = stored(named.join(names, "component").select("node", "name"), "components")
    component = F.coalesce("name", "rep", "doc_id")
    return (
        signed.select("doc_id", "text_hash", "n_shingles", "set_key")
        .join(classes, "set_key", "left")
        .join(named, "node", "left")
        .select(
            "doc_id",
            "text_hash",
            "n_shingles",
            F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
            (F.col("doc_id").isNull() | (F.col("doc_id") == component)).alias("kept"),
        )
    )


def without_near_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", threshold: int = THRESHOLD) -> DataFrame:
    """The rows of `docs` without near copies of a row with a smaller identifier, unchanged. Rows are judged by identifier
    and text, so a repeated identifier neither links its texts nor drops one for another."""
    dropped = _judged(docs, doc_id, text, threshold, by_id=False).filter(~F.col("kept"))
    return without_rows(docs, [F.col(doc_id).cast("long"), _text_hash(text)], dropped.select("doc_id", "text_hash"))
