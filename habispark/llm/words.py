"""Words of whole texts as NumPy arrays, straight from Arrow buffers.

A word is a maximal run of `[^\\x20\\x09-\\x0D]`. All positions are byte positions in UTF-8; the
separators are ASCII, so cutting there never splits a character. Hashes are 64-bit polynomial hashes
modulo 2**64 over random per-byte values, mixed at the end, so that the hash of any slice follows
from prefix sums and nothing is done per word in Python.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Texts are worked through in slices of about this many bytes, one text at least.
SLICE_BYTES = 1 << 20

_PRIME = 0x9E3779B97F4A7C15 | 1
WORD_PRIME = 0xD6E8FEB86659FD93 | 1
_SEPARATOR = np.zeros(256, bool)
_SEPARATOR[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32
_BYTE_VALUES = np.random.RandomState(2024).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
# For a second hash that has nothing to do with the first.
_OTHER_PRIME = 0xA0761D6478BD642F
_OTHER_VALUES = np.random.RandomState(4202).randint(0, 2**63, 256, dtype=np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_powers: dict[int, np.ndarray] = {}


def powers(base: int, count: int) -> np.ndarray:
    """base**0 … base**(count - 1) modulo 2**64, kept and grown as needed."""
    known = _powers.get(base)
    if known is None or len(known) < count:
        steps = np.full(max(count, 2 * SLICE_BYTES), base, np.uint64)
        steps[0] = 1
        known = _powers[base] = np.cumprod(steps)
    return known[:count]


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers in which every output bit depends on every input bit."""
    x = values.copy()
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def hash_slices(values: np.ndarray, base: int, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of values[start:end] for every pair, independent of where the span lies."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers(base, len(values)), out=sums[1:])
    inverse = powers(pow(base, -1, 1 << 64), len(values) + 1)
    return mix((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64) * np.uint64(WORD_PRIME))


@dataclass
class Texts:
    """Some texts: `data[offsets[i]:offsets[i + 1]]` is text i, its words are `first[i]:first[i + 1]`."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray

    @property
    def count(self) -> int:
        return len(self.offsets) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def owner(self) -> np.ndarray:
        """The number of the text of each word."""
        return np.repeat(np.arange(self.count), self.counts)

    def hashes(self) -> np.ndarray:
        return self.hash_spans(self.start, self.end)

    def other_hashes(self) -> np.ndarray:
        return hash_slices(_OTHER_VALUES[self.data], _OTHER_PRIME, self.start, self.end)

    def hash_spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return hash_slices(_BYTE_VALUES[self.data], _PRIME, start, end)

    def windows(self, hashes: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of every run of `size` words inside one text."""
        at = np.arange(len(hashes))
        last = np.repeat(self.first[1:], self.counts)
        at = at[at + size <= last]
        return at, hash_slices(hashes, WORD_PRIME, at, at + size)

    def word_bytes(self, i: int) -> bytes:
        return self.data[self.start[i] : self.end[i]].tobytes()


def read_texts(column: pa.Array, lower: bool = False) -> Texts:
    """Words of a string column; NULL counts as empty. `lower` maps A-Z only."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = np.int64 if pa.types.is_large_string(column.type) else np.int32
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], wide)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(buffers[2], np.uint8) if buffers[2] is not None else np.zeros(0, np.uint8)
    data = raw[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    blank = np.ones(len(data) + 2, bool)
    blank[1:-1] = _SEPARATOR[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = ~blank[1:-1]
    start = np.flatnonzero(inside & (blank[:-2] | edge[:-1]))
    end = np.flatnonzero(inside & (blank[2:] | edge[1:])) + 1
    return Texts(data, offsets, start, end, np.searchsorted(start, offsets))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in pieces of about `limit` bytes of text, so that memory follows the longest text."""
    if not batch.num_rows:
        return
    lengths = np.asarray(pc.binary_length(batch.column(column)).fill_null(0))
    part = (np.cumsum(lengths) - lengths) // limit
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[i]:first[i + 1]] for every i."""
    total = np.zeros(len(values) + 1, np.result_type(values, np.int64))
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def repeated(owner: np.ndarray, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each entry: is the same hash found again in the same text, and is it an earlier one's copy?"""
    key = mix(hashes ^ mix(owner.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    same = ordered[1:] == ordered[:-1]
    again, later = np.zeros(len(key), bool), np.zeros(len(key), bool)
    again[order[1:]] |= same
    later[order[1:]] |= same
    again[order[:-1]] |= same
    return again, later
