"""Text measurements over chunks of whole texts, each returning one value per text."""

from __future__ import annotations

from functools import wraps

import numpy as np

from .common import SpanHash, mix, ngram_hash, owner, word_spans
from .units import spread

# The characters that count as symbols.
SYMBOLS = "#*$%&|<>"

_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in SYMBOLS]] = True
_HEAD = (np.arange(256) & 0xC0) != 0x80  # first byte of a code point
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = _LETTER[128:] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[ord(c) for c in ".,;:!?'\"()-"]] = True


def measured(f):
    """A measurement of one value per text that is made once."""

    @wraps(f)
    def once(self, *args):
        return self._once((f.__name__, *args), lambda: f(self, *args))

    return once


class TextBlock:
    """Lazily measured texts of one chunk; what a rule doesn't ask for is never computed."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data, self.offsets, self.n = data, offsets, len(offsets) - 1
        self._cache: dict[str, object] = {}

    def _once(self, name, make):
        if name not in self._cache:
            self._cache[name] = make()
        return self._cache[name]

    def per_text(self, flags: np.ndarray) -> np.ndarray:
        """Set flags of each text, from one flag per byte."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def per_word(self, values: np.ndarray) -> np.ndarray:
        total = np.zeros(len(values) + 1, np.int64)
        np.cumsum(values, out=total[1:])
        bounds = self.words[2]
        return total[bounds[1:]] - total[bounds[:-1]]

    def subset(self, keep: np.ndarray) -> TextBlock:
        """Some of the texts, with what is measured of them so far."""
        size = np.diff(self.offsets)[keep]
        offsets = np.concatenate(([0], np.cumsum(size)))
        out = TextBlock(self.data[spread(self.offsets[keep], size)], offsets)
        if "words" in self._cache:
            start, end, bounds = self.words
            count = np.diff(bounds)[keep]
            of = spread(bounds[keep], count)
            moved = np.repeat(offsets[:-1] - self.offsets[keep], count)
            out._cache["words"] = (start[of] + moved, end[of] + moved, np.concatenate(([0], np.cumsum(count))))
            out._cache |= {name: self._cache[name][of] for name in ("lengths", "word_hash") if name in self._cache}
        if "lines" in self._cache:
            h, of = self._cache["lines"]
            place = np.full(self.n, -1)
            place[keep] = np.arange(len(keep))
            own = place[of] >= 0
            out._cache["lines"] = (h[own], place[of[own]])
        for name in self._cache.keys() - {"words", "lengths", "word_hash", "lines", "hasher"}:
            out._cache[name] = self._cache[name][keep]
        return out

    @property
    def words(self):
        return self._once("words", lambda: word_spans(self.data, self.offsets))

    @property
    def hasher(self) -> SpanHash:
        return self._once("hasher", lambda: SpanHash(self.data))

    @property
    def word_hash(self) -> np.ndarray:
        return self._once("word_hash", lambda: self.hasher.of(self.words[0], self.words[1]))

    @measured
    def n_words(self) -> np.ndarray:
        return np.diff(self.words[2])

    def word_lengths(self) -> np.ndarray:
        def make():
            heads = np.zeros(len(self.data) + 1, np.int64)
            np.cumsum(_HEAD[self.data], out=heads[1:])
            start, end, _ = self.words
            return heads[end] - heads[start]

        return self._once("lengths", make)

    @measured
    def word_chars(self) -> np.ndarray:
        return self.per_word(self.word_lengths())

    @measured
    def n_chars(self) -> np.ndarray:
        return self.per_text(_HEAD[self.data])

    @measured
    def n_symbols(self) -> np.ndarray:
        return self.per_text(_SYMBOL[self.data])

    @measured
    def n_upper(self) -> np.ndarray:
        return self.per_text(_UPPER[self.data])

    def n_digits(self) -> np.ndarray:
        return self.per_text(_DIGIT[self.data])

    @measured
    def n_letters(self) -> np.ndarray:
        return self.per_text(_LETTER[self.data] & _HEAD[self.data])

    def n_punct(self) -> np.ndarray:
        return self.per_text(_PUNCT[self.data])

    def lines(self):
        """Hash of each line that holds a word, and the text it belongs to."""

        def make():
            cut = np.flatnonzero(self.data == 10)
            start = np.union1d(self.offsets[:-1], cut + 1)
            start = start[start < len(self.data)]
            if not len(start):
                return np.zeros(0, np.uint64), np.zeros(0, np.int64)
            of = np.searchsorted(self.offsets, start, "right") - 1
            following = np.append(start[1:], len(self.data))
            end = np.minimum(following, self.offsets[of + 1])
            end = end - ((end > start) & (self.data[np.maximum(end, 1) - 1] == 10))
            first = self.words[0]
            has_word = np.searchsorted(first, end) > np.searchsorted(first, start)
            return self.hasher.of(start[has_word], end[has_word]), of[has_word]

        return self._once("lines", make)

    @measured
    def n_lines(self) -> np.ndarray:
        return np.bincount(self.lines()[1], minlength=self.n)

    @measured
    def n_dup_lines(self) -> np.ndarray:
        h, of = self.lines()
        key = h ^ mix(of.astype(np.uint64) + np.uint64(1))
        _, first = np.unique(key, return_index=True)
        return self.n_lines() - np.bincount(of[first], minlength=self.n)

    @measured
    def n_repeat_words(self, window: int = 8) -> np.ndarray:
        """Words inside windows that occur twice or more in their text, the first occurrence included."""
        bounds = self.words[2]
        h, first = ngram_hash(self.word_hash, bounds, window)
        if not len(h):
            return np.zeros(self.n, np.int64)
        key = h ^ mix(owner(bounds)[first].astype(np.uint64) + np.uint64(1))
        order = np.argsort(key)
        same = key[order][1:] == key[order][:-1]
        twice = np.zeros(len(key), bool)
        twice[order[1:][same]] = True
        twice[order[:-1][same]] = True
        edge = np.zeros(len(self.word_hash) + 1, np.int64)
        np.add.at(edge, first[twice], 1)
        np.add.at(edge, first[twice] + window, -1)
        return self.per_word(np.cumsum(edge)[:-1] > 0)

    def n_distinct_words(self) -> np.ndarray:
        of = owner(self.words[2])
        key = self.word_hash ^ mix(of.astype(np.uint64) + np.uint64(1))
        _, first = np.unique(key, return_index=True)
        return np.bincount(of[first], minlength=self.n)

    def longest_word(self) -> np.ndarray:
        lengths, bounds = self.word_lengths(), self.words[2]
        out = np.zeros(self.n, np.int64)
        some = np.diff(bounds) > 0
        if some.any():
            out[some] = np.maximum.reduceat(lengths, bounds[:-1][some])
        return out

    def n_short_words(self) -> np.ndarray:
        return self.per_word(self.word_lengths() <= 3)

    def n_end_symbol_words(self) -> np.ndarray:
        """Words that end in one of the symbols."""
        return self.per_word(_SYMBOL[self.data[self.words[1] - 1]])

    @measured
    def n_same_next(self) -> np.ndarray:
        """Words equal to the one before them in the same text."""
        h, bounds = self.word_hash, self.words[2]
        same = np.zeros(len(h), bool)
        same[1:] = h[1:] == h[:-1]
        same[bounds[:-1][bounds[:-1] < len(h)]] = False
        return self.per_word(same)


FEATURES = (
    "log_words", "mean_length", "longest", "symbol_share", "symbol_word_share", "upper_share", "digit_share", "letter_share",
    "punct_share", "short_share", "distinct_share", "dup_line_share", "repeat_share", "same_next_share", "words_per_line",
)


def feature_matrix(block: TextBlock) -> np.ndarray:
    """One row of FEATURES per text; an empty text gives zeros."""
    words = block.n_words()
    w, chars = np.maximum(words, 1), np.maximum(block.word_chars(), 1)
    lines = block.n_lines()
    columns = [
        np.log1p(words), block.word_chars() / w, np.log1p(block.longest_word()), block.n_symbols() / chars, block.n_end_symbol_words() / w,
        block.n_upper() / chars, block.n_digits() / chars, block.n_letters() / chars, block.n_punct() / chars, block.n_short_words() / w,
        block.n_distinct_words() / w, block.n_dup_lines() / np.maximum(lines, 1), block.n_repeat_words() / w, block.n_same_next() / w,
        np.log1p(words / np.maximum(lines, 1)),
    ]
    return np.stack(columns, 1).astype(np.float64)
