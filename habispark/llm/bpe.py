"""Byte-level BPE of whole texts; long ones are encoded as a tree of halves.

A text longer than LEAF characters is halved until its parts are short enough. The parts of a text are encoded
in parallel. Then neighbours are joined up the tree: a window around the join, which begins where the
left side is known to begin a pre-token, is encoded anew and grows until it begins like the left side
and ends a pre-token where the right side ends one as well. From there on both scans see the same characters
from the same place, so the joined tokens are exactly those of the whole text.

A pre-token longer than LEAF bytes has no such places. It is a tree of its own, of bytes: the window covers the last
tokens of the left and the first ones of the right side, and is encoded anew, growing, until the token before it and its
first one, and its last one and the token behind it, are each what encoding just these two gives. Byte-pair merging
makes such a sequence the encoding of the whole: the first merge across a border of two tokens would be one between just these two
as well. So a join costs a few tokens, whatever the length of its sides. A side whose tokens are out of step with the window
over its whole length (one letter repeated) is encoded anew; windows grow fourfold, so that this costs little more than once a level.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from habispark.llm.words import read_texts, slices, sums_by_text

# Fixed value: the published pre-tokenizer pattern of this kind of vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# How far beyond its end the longest alternative of the pattern may look.
LOOKAHEAD = 2
LEAF = 1 << 14
WINDOW = 32
GROWTH = 4
_THREADS = 2
# White space to the pattern, but no separator of words here; the last ASCII ones are so to some engines only.
_OTHER_SPACE = r"[\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_ENCODED = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def _byte_letters() -> dict[str, int]:
    """The printable letter that stands for each byte in a vocabulary file: itself, or the next free one above 255."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Codec:
    """Encodes and decodes with the vocabulary of a tokenizer file, without its truncation and padding."""

    def __init__(self, path: str, leaf: int = LEAF, window: int = WINDOW):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letters = _byte_letters()
        self.special = {x["content"]: x["id"] for x in content["added_tokens"]}
        ranks = {
            bytes(letters[c] for c in token): i
            for token, i in content["model"]["vocab"].items()
            if token not in self.special
        }
        self.encoding = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.pattern = regex.compile(PATTERN)
        known = {i: b for b, i in ranks.items()} | {i: s.encode() for s, i in self.special.items()}
        self.bytes = [known.get(i, b"") for i in range(max(known) + 1)]
        self.numbers = [str(i).encode() for i in range(len(self.bytes))]
        self.split = regex.compile("|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) or "(?!)")
        self.leaf, self.window = max(leaf, 4), max(window, 4)
        self.unsplit = regex.compile("|".join(rf"{c}{{{self.leaf},}}" for c in (r"\p{L}", r"\p{N}", r"[^\s\p{L}\p{N}]", r"\s")))

    def encode(self, text: str) -> list[int]:
        """Text equal to a special token becomes that token."""
        if not any(s in text for s in self.special):
            return self._whole(text)
        out, at = [], 0
        for found in self.split.finditer(text):
            out += self._whole(text[at : found.start()])
            out.append(self.special[found[0]])
            at = found.end()
        return out + self._whole(text[at:])

    def decode(self, ids: list[int]) -> str:
        return b"".join([self.bytes[i] for i in ids]).decode("utf-8", errors="replace")

    def counts(self, column: pa.Array) -> np.ndarray:
        """Tokens of every text of a string column, NULL counts as empty; as `encode` gives them, but no token is made twice for
        one word. No pre-token goes on behind the end of a word, so a word with the separators before it is
        encoded alone, once for all its places in the column."""
        column = column.fill_null("") if column.null_count else column
        texts = read_texts(column)
        cuts = np.sort(np.concatenate([texts.offsets, texts.end]), kind="stable")  # two ascending runs, merged
        cuts = cuts[np.concatenate([[True], cuts[1:] > cuts[:-1]])]
        units = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(np.ascontiguousarray(texts.data))]
        ).dictionary_encode()
        each = np.array([len(self._whole(u.decode())) for u in units.dictionary.to_pylist()], np.int64)
        out = sums_by_text(each[units.indices.to_numpy()], np.searchsorted(cuts, texts.offsets))
        # Texts in which other characters separate, or special tokens stand, are encoded whole.
        odd = pc.match_substring_regex(column, _OTHER_SPACE)
        for special in self.special:
            odd = pc.or_(odd, pc.match_substring(column, special))
        for i in np.flatnonzero(odd.to_numpy(zero_copy_only=False)):
            out[i] = len(self.encode(column[i].as_py()))
        return out

    def _whole(self, text: str) -> list[int]:
        if len(text) <= self.leaf:
            return self.encoding.encode_ordinary(text)
        if not self.unsplit.search(text):
            return self._tree(text)
        return [i for found in self.pattern.finditer(text) for i in self._piece(found[0].encode())]

    def _piece(self, piece: bytes) -> list[int]:
        """Tokens of one pre-token."""
        if len(piece) <= self.leaf:
            return self.encoding._encode_single_piece(piece)
        parts = [piece]
        while len(parts[0]) > self.leaf:
            parts = [h for p in parts for h in (p[: (len(p) + 1) // 2], p[(len(p) + 1) // 2 :])]
        with ThreadPoolExecutor(_THREADS) as pool:
            nodes = list(pool.map(self.encoding._encode_single_piece, parts))
        while len(nodes) > 1:
            nodes = [self._joined(x, y) for x, y in zip(nodes[::2], nodes[1::2], strict=True)]
        return nodes[0]

    def _spelt(self, tokens: list[int]) -> bytes:
        return b"".join([self.bytes[i] for i in tokens])

    def _joined(self, left: list[int], right: list[int]) -> list[int]:
        """Tokens of the bytes of both sides, which are the tokens of the bytes of each."""

        def agree(a: list[int], b: list[int]) -> bool:
            pair = a[-1:] + b[:1]
            return len(pair) < 2 or self.encoding._encode_single_piece(self._spelt(pair)) == pair

        size = self.window
        while True:
            before, after = left[:-size], right[size:]
            window = self.encoding._encode_single_piece(self._spelt(left[-size:] + right[:size]))
            if agree(before, window) and agree(window, after):
                return before + window + after
            size *= GROWTH

    def _tree(self, text: str) -> list[int]:
        parts = [(0, len(text))]
        while max(b - a for a, b in parts) > self.leaf:
            parts = [p for a, b in parts for p in ((a, (a + b) // 2), ((a + b) // 2, b))]
        tokens = self.encoding.encode_ordinary_batch([text[a:b] for a, b in parts], num_threads=_THREADS)
        # Start, end, tokens, and a place where a pre-token begins, with the number of tokens before it.
        nodes = [(a, b, t, a, 0) for (a, b), t in zip(parts, tokens, strict=True)]
        while len(nodes) > 1:
            nodes = [self._join(text, x, y) for x, y in zip(nodes[::2], nodes[1::2], strict=True)]
        return nodes[0][2]

    def _starts(self, text: str, begin: int, end: int, last: int) -> list[tuple[int, int]]:
        """(place, tokens before it) of the pre-tokens of text[begin:end] from `begin` on, up to `last`."""
        out, count = [(begin, 0)], 0
        for found in self.pattern.finditer(text[begin:end]):
            count += len(self.encoding.encode_ordinary(found[0]))
            if begin + found.end() > last:
                break
            out.append((begin + found.end(), count))
        return out

    def _join(self, text: str, left: tuple, right: tuple) -> tuple:
        begin, middle, tokens, known, before = left
        _, end, more, later, later_count = right
        # All pre-token starts of the left side but those too near its end are starts in the whole text.
        sure = self._starts(text, known, middle, middle - LOOKAHEAD)
        size, back = self.window, 1
        while True:
            start, skipped = sure[max(0, len(sure) - 1 - back)]
            stop = min(end, middle + size)
            last = end if stop == end else stop - LOOKAHEAD
            window = self._starts(text, start, stop, last)
            near = middle - LOOKAHEAD
            agrees = [p for p, _ in window if p <= near] == [p for p, _ in sure if start <= p <= near]
            theirs = dict(self._starts(text, middle, stop, last))
            common = next(((p, n) for p, n in window if p in theirs and p > start), None)
            whole = stop == end and start == known
            if whole or agrees and (common or stop == end):
                break
            size, back = 2 * size, 2 * back
        place, count = common or (end, window[-1][1])
        kept = before + skipped
        fresh = [i for p in self.pattern.findall(text[start:place] if place == end else text[start:stop]) for i in self.encoding.encode_ordinary(p)][:count]
        rest = more[theirs[place] :] if common else []
        out = tokens[:kept] + fresh + rest
        # The place handed on must stay certain when the text goes on behind `end`.
        if common and place <= later <= end - LOOKAHEAD:
            return begin, end, out, later, kept + count - theirs[place] + later_count
        if place <= end - LOOKAHEAD:
            return begin, end, out, place, kept + count
        return begin, end, out, start, kept


@lru_cache(maxsize=4)
def codec(path: str) -> Codec:
    """One per Python worker and vocabulary."""
    return Codec(path)


def encoded(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of the decimal ids joined by commas) and decoded_sha256 for every row of
    `docs`; see `token_ids` for the ids themselves. NULL counts as empty, and an empty text has no tokens. Rows are encoded
    one by one, so repeated rows and NULL identifiers are no special case. A text of any length is encoded whole, by one task. An
    empty table gives an empty result, and other columns of `docs` may have any name."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                rows = [tool.encode(t or "") for t in part.column("text").to_pylist()]
                digest = lambda b: hashlib.sha256(b).hexdigest()
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id"),
                        pa.array([len(r) for r in rows], pa.int64()),
                        pa.array([digest(b",".join([tool.numbers[i] for i in r])) for r in rows]),
                        pa.array([digest(tool.decode(r).encode()) for r in rows]),
                    ],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, _ENCODED)


def token_counts(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and length (tokens, as in `encoded`, and one end mark) for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                counts = tool.counts(part.column("text")) + 1
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(counts, pa.int64())], ["doc_id", "length"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, length long"
    )


def token_ids(docs: DataFrame, path: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ids (array of int) for every row of `docs`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tool = codec(path)
        for batch in batches:
            for part in slices(batch, "text"):
                ids = pa.array([tool.encode(t or "") for t in part.column("text").to_pylist()], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), ids], ["doc_id", "ids"])

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, "doc_id long, ids array<int>"
    )
