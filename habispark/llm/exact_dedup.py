"""Exact deduplication by a tree-merge of sorted digest runs.

Every partition of the input sorts the digests of its own texts into runs in which a digest occurs
once, with the identifier that stays and a count. Runs are then exchanged in binomial rounds: in round k, neighbours
2**(k-1) apart cut their runs in two by the k-th bit of the digest, one side takes both lower halves and the other
both upper ones, and a multiway merge leaves one run of each. So there are as many runs of the same size in every
round, and after log2(partitions) rounds a digest is in one run only. A text with any number of copies is one entry
per run from the start, so no task ever holds a group of copies.

The entry of a text is its SHA-256, its length in bytes and an independent 64-bit hash; entries are
one text only if all three agree, which every merge verifies.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import lower_ascii, partitions, stored, without_rows

# Rounds after which the runs are written, so that a lost executor costs no more than these.
_STORED_EVERY = 5
# Entries a partition gathers before it closes a run: bounds the memory of a task.
RUN_ENTRIES = 1 << 20
_KEY = 48
_ENTRY = np.dtype([("key", f"S{_KEY}"), ("keep", "<i8"), ("size", "<i8")])
_RUNS = "slot long, run long, entries binary"


def text_key(text: Column) -> Column:
    """48 bytes that stand for a text: SHA-256, length, xxhash64."""
    number = lambda c: F.unhex(F.lpad(F.hex(c), 16, "0"))
    return F.concat(
        F.unhex(F.sha2(text.cast("binary"), 256)),
        number(F.octet_length(text).cast("long")),
        number(F.xxhash64(text)),
    )


def merged(runs: list[np.ndarray], largest: bool) -> np.ndarray:
    """One sorted run out of several. The stable sort finds the sorted runs and merges them."""
    entries = np.concatenate(runs)
    entries = entries[np.argsort(entries["key"], kind="stable")]
    first = np.flatnonzero(np.concatenate([[True], entries["key"][1:] != entries["key"][:-1]]))
    out = entries[first]
    out["keep"] = (np.maximum if largest else np.minimum).reduceat(entries["keep"], first)
    out["size"] = np.add.reduceat(entries["size"], first)
    return out


def merge_tree(keyed: DataFrame, key: str, doc_id: str, largest: bool = False) -> DataFrame:
    """Columns key, keep_id, group_size: one row for every key with two rows or more."""
    rounds = max(1, (partitions(keyed) - 1).bit_length())

    def halves(entries: np.ndarray, depth: int, run: int) -> dict[str, list]:
        """A sorted run cut by the first `depth` bits of the digests; all but the last of them are equal."""
        lead = np.frombuffer(entries["key"].astype(f"S{_KEY}").tobytes(), np.uint8)
        slot = lead.reshape(-1, _KEY)[:, :4].copy().view(">u4").ravel().astype(np.int64) >> (32 - depth)
        cuts = [0, *(np.flatnonzero(np.diff(slot)) + 1), len(slot)]
        return {
            "slot": slot[cuts[:-1]].tolist(),
            "run": [run >> 1] * (len(cuts) - 1),
            "entries": [entries[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        }

    def local_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        run = TaskContext.get().partitionId()
        gathered: list[np.ndarray] = []
        types = pa.schema([("slot", pa.int64()), ("run", pa.int64()), ("entries", pa.binary())])

        def close() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(halves(merged(gathered, largest), 1, run), types)

        for batch in batches:
            entries = np.zeros(batch.num_rows, _ENTRY)
            entries["key"] = np.array(batch.column(0).to_pylist(), f"S{_KEY}")
            entries["keep"] = batch.column(1).to_numpy(zero_copy_only=False)
            entries["size"] = 1
            gathered.append(entries)
            if sum(map(len, gathered)) >= RUN_ENTRIES:
                yield close()
                gathered.clear()
        if gathered:
            yield close()

    # A missing identifier never wins against a present one.
    lowest, highest = -(2**63), 2**63 - 1
    absent = lowest if largest else highest
    runs = keyed.select(key, F.coalesce(F.col(doc_id).cast("long"), F.lit(absent))).mapInArrow(local_runs, _RUNS)

    def merge(group: pd.DataFrame) -> np.ndarray:
        return merged([np.frombuffer(x, _ENTRY) for x in group["entries"]], largest)

    def exchange(depth: int):
        return lambda group: pd.DataFrame(halves(merge(group), depth, int(group["run"].iloc[0])))

    for done in range(1, rounds):
        runs = runs.groupBy("slot", "run").applyInPandas(exchange(done + 1), _RUNS)
        if done % _STORED_EVERY == 0:
            runs = stored(runs, "digest-runs")

    def last(group: pd.DataFrame) -> pd.DataFrame:
        entries = merge(group)
        entries = entries[entries["size"] > 1]
        keys = np.frombuffer(entries["key"].tobytes(), f"V{_KEY}")
        return pd.DataFrame(
            {"key": [x.tobytes() for x in keys], "keep_id": entries["keep"], "group_size": entries["size"]}
        )

    found = runs.groupBy("slot", "run").applyInPandas(last, "key binary, keep_id long, group_size long")
    return found.withColumn("keep_id", F.nullif(F.col("keep_id"), F.lit(absent)))


def duplicate_groups(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: bool = False
) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row of `docs`.

    Texts are equal if they are identical after A-Z is lower-cased; NULL counts as empty, and empty
    texts are equal to each other. The row with the smallest (`largest`: the largest) identifier stays.
    Rows that repeat an identifier all count in group_size, and each with the identifier that stays is
    kept. A NULL identifier stays only where its whole group has none. Other columns of `docs` may have
    any name. An empty table gives an empty result.
    """
    return _verdicts(docs, doc_id, text, largest).select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex(F.substring("text_key", 1, 32))).alias("text_sha256")
    )


def _keys(doc_id: str, text: str) -> list[Column]:
    return [F.col(doc_id).cast("long").alias("doc_id"), text_key(lower_ascii(F.col(text))).alias("text_key")]


def _verdicts(docs: DataFrame, doc_id: str, text: str, largest: bool) -> DataFrame:
    keyed = docs.select(*_keys(doc_id, text))
    # Written once, as it feeds both the runs and the verdicts: 56 bytes a document.
    keyed = stored(keyed, "digests")
    groups = stored(merge_tree(keyed, "text_key", "doc_id", largest), "copies")
    # Only texts with copies are on the right, one row each; a hot text is a skewed left side, which
    # adaptive execution splits.
    joined = keyed.join(groups.withColumnRenamed("key", "text_key"), "text_key", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id"))
    return joined.select(
        "doc_id",
        keep.alias("keep_id"),
        F.coalesce(F.col("group_size"), F.lit(1).cast("long")).alias("group_size"),
        keep.eqNullSafe(F.col("doc_id")).alias("kept"),
        "text_key",
    )


def without_copies(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", largest: bool = False) -> DataFrame:
    """The rows of `docs` that `duplicate_groups` keeps, unchanged; of rows that are repeated whole,
    identifier included, all stay. Rows go by identifier and text, so other texts of the same (or no) identifier stay."""
    dropped = _verdicts(docs, doc_id, text, largest).filter(~F.col("kept"))
    return without_rows(docs, _keys(doc_id, text), dropped.select("doc_id", "text_key"))
