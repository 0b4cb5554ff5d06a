"""Statistics of whole texts and of their lines, computed for many texts at once."""

from __future__ import annotations

import numpy as np

from habispark.llm.words import Texts, repeated, sums_by_text

SYMBOLS = b"#*$%&|<>"
_CLASS = {
    "symbol": np.isin(np.arange(256), list(SYMBOLS)),
    "mark": np.isin(np.arange(256), list(b".,;:!?\"'()[]{}/\\-_=+~^@`")),
    "exclamation": np.arange(256) == ord("!"),
    "upper": (np.arange(256) >= ord("A")) & (np.arange(256) <= ord("Z")),
    "digit": (np.arange(256) >= ord("0")) & (np.arange(256) <= ord("9")),
    # Every byte that begins a character.
    "character": (np.arange(256) & 0xC0) != 0x80,
}


class Measured:
    """Counts per text, and per line for the lines that hold a word."""

    def __init__(self, texts: Texts):
        self.texts = texts
        data, size = texts.data, len(texts.data)
        word = np.zeros(size + 1, np.int64)
        word[texts.start] += 1
        np.add.at(word, texts.end, -1)
        inside = np.cumsum(word)[:size] > 0
        self.sums = {k: np.concatenate([[0], np.cumsum(v[data])]) for k, v in _CLASS.items()}
        letters = np.concatenate([[0], np.cumsum(_CLASS["character"][data] & inside)])
        self.word_chars = letters[texts.offsets[1:]] - letters[texts.offsets[:-1]]
        self.n_symbols = self.between("symbol", texts.offsets[:-1], texts.offsets[1:])
        self.word_lengths = letters[texts.end] - letters[texts.start]
        self.hashes = texts.hashes()
        owner = texts.owner()

        at, runs = texts.windows(self.hashes, 3)
        again, _ = repeated(owner[at], runs)
        steps = np.zeros(len(self.hashes) + 1, np.int64)
        np.add.at(steps, at[again], 1)
        np.add.at(steps, at[again] + 3, -1)
        self.in_repeat = np.cumsum(steps)[: len(self.hashes)] > 0
        self.n_repeat_words = sums_by_text(self.in_repeat, texts.first)
        _, seen = repeated(owner, self.hashes)
        self.n_distinct = texts.counts - sums_by_text(seen, texts.first)

        # Lines: a text ends its last one, whether or not a line break does.
        breaks = np.flatnonzero(data == ord("\n"))
        start = np.unique(np.concatenate([texts.offsets[:-1][np.diff(texts.offsets) > 0], breaks + 1]))
        start = start[start < size]
        end = np.append(start[1:], size)
        # A line that ends in a break leaves it out.
        end = np.where((end > start) & (data[np.maximum(end, 1) - 1] == ord("\n")), end - 1, end) if size else end
        first_word = np.searchsorted(texts.start, start)
        last_word = np.searchsorted(texts.start, end)
        full = last_word > first_word
        self.line_start, self.line_end = start[full], end[full]
        self.line_words = np.stack([first_word[full], last_word[full]])
        self.line_owner = np.searchsorted(texts.offsets, self.line_start, side="right") - 1
        self.first_line = np.searchsorted(self.line_owner, np.arange(texts.count + 1))
        self.line_again, self.line_copy = repeated(self.line_owner, texts.hash_spans(self.line_start, self.line_end))
        self.n_dup_lines = sums_by_text(self.line_copy, self.first_line)

    def between(self, kind: str, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return self.sums[kind][end] - self.sums[kind][start]

    def line_features(self) -> np.ndarray:
        """One row per line: a constant, then shares and logarithms of moderate size."""
        a, b = self.line_start, self.line_end
        chars = np.maximum(self.between("character", a, b), 1)
        n = np.diff(self.line_words, axis=0)[0]
        letters = np.concatenate([[0], np.cumsum(self.word_lengths)])
        repeats = np.concatenate([[0], np.cumsum(self.in_repeat)])
        lengths = letters[self.line_words[1]] - letters[self.line_words[0]]
        closing = self.texts.data[self.texts.end[self.line_words[1] - 1] - 1] if len(a) else np.zeros(0, np.uint8)
        share = lambda kind: self.between(kind, a, b) / chars
        return np.stack(
            [
                np.ones(len(a)),
                np.log1p(n) / 3,
                np.sqrt(share("symbol")) * 3,
                np.sqrt(share("mark")) * 3,
                np.sqrt(share("exclamation")) * 3,
                np.sqrt(share("upper")) * 2,
                np.sqrt(share("digit")) * 3,
                lengths / np.maximum(n, 1) / 8,
                self.line_again * 1.0,
                (repeats[self.line_words[1]] - repeats[self.line_words[0]]) / np.maximum(n, 1),
                np.isin(closing, list(b".!?:;\"")) * 1.0,
            ],
            axis=1,
        ).astype(np.float32)

    def document_features(self) -> np.ndarray:
        """One row per text: shares as shifted log-odds, counts as logarithms."""
        t = self.texts
        a, b = t.offsets[:-1], t.offsets[1:]
        chars = self.between("character", a, b)
        n, lines = t.counts, np.diff(self.first_line)

        def odds(part, whole):
            return np.log((part + 0.5) / (np.maximum(whole - part, 0) + 0.5))

        short = sums_by_text(self.word_lengths <= 3, t.first)
        squares = sums_by_text(self.word_lengths.astype(np.float64) ** 2, t.first)
        mean = self.word_chars / np.maximum(n, 1)
        spread = np.sqrt(np.maximum(squares / np.maximum(n, 1) - mean**2, 0))
        alone = sums_by_text(self.word_lengths == 1, t.first)
        return np.stack(
            [
                np.log1p(n),
                np.log1p(mean),
                np.log1p(spread),
                odds(self.n_symbols, chars),
                odds(self.between("mark", a, b), chars),
                odds(self.between("exclamation", a, b), chars),
                odds(self.between("upper", a, b), chars),
                odds(self.between("digit", a, b), chars),
                odds(self.n_dup_lines, lines),
                odds(self.n_repeat_words, n),
                odds(self.n_distinct, n),
                odds(short, n),
                odds(alone, n),
                np.log1p(n / np.maximum(lines, 1)),
            ],
            axis=1,
        )
