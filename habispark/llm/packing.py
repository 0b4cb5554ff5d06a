"""Best-fit packing of documents into sequences of several permitted lengths.

Documents are cut into pieces no longer than the largest length and dealt by hash into shares of
bounded size, which are packed independently. In a share, the longest piece comes first and goes into the
open bin it fits most tightly. If it fits none, every permitted length is tried with the pieces still to come: the
largest ones that fit fill it up, it is downsized to the smallest length that holds them, and the length that so costs
least per token is opened. A sequence costs OVERHEAD, one per place and, for attention, the square of its length
over ATTENTION, so no length is cheapest by itself. At the end every bin is downsized to its contents. A share whose
bins would cost less if all opened at the largest length is packed that way.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.tables import stored

LENGTHS = (256, 512, 1024, 2048)
# What a sequence costs besides its tokens.
OVERHEAD = 16
# Length at which attention costs as much as all else that grows with the length.
ATTENTION = 65536
# Pieces of a share, on average: bounds what a task holds.
SHARE_PIECES = 50_000
_PACKED = "bin_id string, capacity int, doc_id long, piece long, start long, length int, position int"


def sequence_cost(length: int, overhead: float = OVERHEAD, attention: float = ATTENTION) -> float:
    return overhead + length + length * length / attention


def _filled(falling: list[int], ends: list[int], i: int, length: int) -> int:
    """Tokens in a bin of that length that opens with piece i and takes the largest later pieces that fit, one after
    another. `falling` are the sizes, negative; `ends` where the pieces of a size end. Sizes taken differ, so there are few steps."""
    room, at = length + falling[i], i + 1
    while room:
        at = bisect_left(falling, -room, at)
        if at == len(falling):
            break
        taken = min(room // -falling[at], ends[at] - at)
        room += taken * falling[at]
        at += taken
    return length - room


def _best_fit(sizes: list[int], opened) -> tuple[list[int], list[int], list[int]]:
    """Bin and position of every piece and the tokens of every bin; `opened(i)` is the length of a new bin for piece i."""
    room: list[int] = []  # distinct free room, ascending
    bins: dict[int, list[int]] = {}
    used: list[int] = []
    chosen, position = [], []
    for i, size in enumerate(sizes):
        at = bisect_left(room, size)
        if at < len(room):
            free = room[at]
            target = bins[free].pop()
            if not bins[free]:
                del bins[free]
                room.pop(at)
        else:
            free, target = opened(i), len(used)
            used.append(0)
        chosen.append(target)
        position.append(used[target])
        used[target] += size
        free -= size
        if free not in bins:
            bins[free] = []
            insort(room, free)
        bins[free].append(target)
    return chosen, position, used


def pack_share(
    sizes: np.ndarray, lengths: Sequence[int], overhead: float = OVERHEAD, attention: float = ATTENTION
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bin and position of every piece, and the capacity of every bin. `sizes` must not increase."""
    lengths = sorted(lengths)
    cost = {c: sequence_cost(c, overhead, attention) for c in lengths}
    falling = (-sizes).tolist()
    ends = np.searchsorted(-sizes, -sizes, side="right").tolist()
    shrunk = lambda tokens: lengths[bisect_left(lengths, tokens)]

    def cheapest(i: int) -> int:
        # Larger pieces open bins first, so the choices of equal sizes follow each other.
        def rate(c: int) -> tuple[float, int]:
            tokens = _filled(falling, ends, i, c)
            return cost[shrunk(tokens)] / tokens, c

        return min((c for c in lengths if c >= -falling[i]), key=rate)

    def total(packing: tuple) -> float:
        return sum(cost[shrunk(tokens)] for tokens in packing[2])

    sizes = sizes.tolist()
    chosen, position, used = min((_best_fit(sizes, opened) for opened in (cheapest, lambda i: lengths[-1])), key=total)
    return np.array(chosen, np.int64), np.array(position, np.int64), np.array([shrunk(t) for t in used], np.int64)


def packed(
    sized: DataFrame,
    doc_id: str = "doc_id",
    length: str = "length",
    lengths: Sequence[int] = LENGTHS,
    overhead: float = OVERHEAD,
    attention: float = ATTENTION,
) -> DataFrame:
    """One row per piece: bin_id, capacity of its bin, doc_id, piece (0, 1, …), start in the document,
    length, position in the bin.

    Rows of `sized` without tokens (length NULL or below 1) are in no bin. Rows that repeat an identifier
    and rows with a NULL one are packed like any other, but rows equal in identifier and length lie in one share. Ties are broken
    by length, identifier and piece. A document of any length is cut into pieces of the largest length. The result does not
    depend on how the rows lie in files. Columns of `sized` besides the two may have any name. An empty table gives an empty result.
    """
    top = max(lengths)
    items = sized.filter(F.col(length) >= 1).select(
        F.col(doc_id).cast("long").alias("doc_id"), F.col(length).cast("long").alias("tokens")
    )
    # Written, as both the number of shares and the pieces need it; a hot source or id does not matter, as pieces
    # are dealt by id, size and number.
    items = stored(items, "token-counts")
    total = items.agg(F.sum(F.expr(f"(tokens - 1) div {top} + 1"))).first()[0] or 0
    shares = total // SHARE_PIECES + 1
    pieces = items.select(
        "doc_id", "tokens", F.explode(F.sequence(F.lit(0).cast("long"), F.expr(f"(tokens - 1) div {top}"))).alias("piece")
    ).select(
        F.pmod(F.xxhash64("doc_id", "tokens", "piece"), F.lit(shares)).alias("share"),
        "doc_id",
        "piece",
        (F.col("piece") * top).alias("start"),
        F.least(F.lit(top), F.col("tokens") - F.col("piece") * top).cast("int").alias("length"),
    )

    def pack(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(
            ["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable", na_position="first"
        )
        chosen, position, capacity = pack_share(group["length"].to_numpy(np.int64), lengths, overhead, attention)
        share = int(group["share"].iloc[0])
        return pd.DataFrame(
            {
                "bin_id": [f"{share}-{b}" for b in chosen],
                "capacity": capacity[chosen].astype(np.int32),
                "doc_id": group["doc_id"].astype("Int64"),
                "piece": group["piece"],
                "start": group["start"],
                "length": group["length"],
                "position": position.astype(np.int32),
            }
        )

    return pieces.groupBy("share").applyInPandas(pack, _PACKED)
