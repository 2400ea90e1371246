"""Token ids of whole texts by way of their distinct pre-tokens.

Byte-pair merges never cross a pre-token, so a text's ids are those of its pre-tokens in order. A
chunk of texts is cut into pre-tokens with array operations, each distinct one is encoded once (and
remembered up to a bounded number), and the ids are laid out by a gather. Texts that the array rules
don't cover (characters outside ASCII and Latin letters) are encoded whole by `encode_text`.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

from .common import SpanHash, text_buffers

#: Array rules hold for ASCII and the precomposed Latin letters (U+0130 changes length in lower case).
_OUTSIDE = re.compile(r"[^\x00-\x7fÀ-ÖØ-öø-įı-ɏ]")
_SPACE_CLASS, _LETTER_CLASS, _DIGIT_CLASS, _OTHER_CLASS = 0, 1, 2, 3
_CLASS = np.full(256, _OTHER_CLASS, np.uint8)
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE_CLASS
_CLASS[48:58] = _DIGIT_CLASS
_CLASS[65:91] = _CLASS[97:123] = _CLASS[128:] = _LETTER_CLASS
TEXTS_BYTES = 1 << 20


def plain(text: str, special: tuple[str, ...]) -> bool:
    return _OUTSIDE.search(text) is None and not any(s in text for s in special)


def cut(data: np.ndarray, offsets: np.ndarray, keep_space: bool) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of every pre-token.

    keep_space: white space counts; one blank joins the run after it, and runs of digits stay whole.
    Otherwise white space is dropped and every digit stands alone. A white-space-delimited run that
    holds an apostrophe or `<` stays whole: contractions and control strings are left to the encoder.
    """
    n = len(data)
    kind = _CLASS[data]
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    first = first[:n]
    solid = kind != _SPACE_CLASS
    change = np.ones(n, bool)
    change[1:] = kind[1:] != kind[:-1]
    begin = (change | first) & solid
    if not keep_space:
        begin |= kind == _DIGIT_CLASS
    run_begin = solid.copy()
    run_begin[1:] &= ~solid[:-1] | first[1:]
    odd = np.flatnonzero((data == 39) | (data == 60))
    if len(odd):
        runs = np.flatnonzero(run_begin)
        held = np.unique(np.searchsorted(runs, odd, "right") - 1)
        stop = _run_end(solid, first)[held]
        inside = np.zeros(n + 1, np.int8)
        inside[runs[held]] = 1
        np.add.at(inside, stop, -1)
        begin &= (np.cumsum(inside[:n]) == 0) | run_begin
    if keep_space:
        joined = np.zeros(n, bool)
        joined[1:] = begin[1:] & (data[:-1] == 32) & ~first[1:]
        begin[1:] &= ~joined[1:]
        lead = np.flatnonzero(joined) - 1
        space = ~solid
        space_first = space.copy()
        space_first[1:] &= solid[:-1] | first[1:]
        # The last blank of a run joins what follows; another last character stands alone.
        space_last = np.zeros(n, bool)
        space_last[:-1] = space[:-1] & solid[1:] & ~first[1:]
        begin |= space_first | space_last
        begin[lead] = True
        start = np.flatnonzero(begin)
        return start, np.append(start[1:], n)
    start = np.flatnonzero(begin)
    following = np.append(start[1:], n)
    return start, np.minimum(following, _next_space(solid, first, start))


def _run_end(solid: np.ndarray, first: np.ndarray) -> np.ndarray:
    """End of every run of solid bytes, in order."""
    last = solid.copy()
    last[:-1] &= ~solid[1:] | first[1:]
    return np.flatnonzero(last) + 1


def _next_space(solid: np.ndarray, first: np.ndarray, start: np.ndarray) -> np.ndarray:
    ends = _run_end(solid, first)
    return ends[np.searchsorted(ends, start, "right")] if len(start) else start


class UnitTable:
    """Ids of the pre-tokens met so far, found by hash in a sorted array; starts afresh beyond `most`.

    Arrays rather than a dict: about 50 bytes a pre-token, and a chunk's distinct hashes, which are
    sorted too, are looked up at once. The bytes of each pre-token are kept and compared, so that one
    whose hash is another's gets its own ids.
    """

    def __init__(self, encode_unit: Callable[[str], list[int]], most: int = 1_000_000):
        self.encode_unit, self.most = encode_unit, most
        self.clear()

    def clear(self) -> None:
        self.keys = np.zeros(0, np.uint64)
        self.at, self.length, self.raw_at, self.size = (np.zeros(0, np.int32) for _ in range(4))
        self.flat, self.used = np.zeros(1 << 18, np.int32), 0
        self.raw, self.raw_used = np.zeros(1 << 18, np.uint8), 0

    def _store(self, new: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of some units lie from now on, and how many each has."""
        length = np.array([len(x) for x in new], np.int32)
        self.flat, self.used = _appended(self.flat, self.used, np.array([i for x in new for i in x], np.int32))
        return (self.used - int(length.sum()) + np.cumsum(length) - length).astype(np.int32), length

    def _encode(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> list[list[int]]:
        return [self.encode_unit(data[a:b].tobytes().decode("utf-8")) for a, b in zip(start.tolist(), end.tolist(), strict=True)]

    def _add(self, place: np.ndarray, keys: np.ndarray, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> None:
        at, length = self._store(self._encode(data, start, end))
        size = end - start
        raw_at = self.raw_used + np.cumsum(size) - size
        self.raw, self.raw_used = _appended(self.raw, self.raw_used, data[spread(start, size)])
        self.keys = np.insert(self.keys, place, keys)
        for name, values in (("at", at), ("length", length), ("raw_at", raw_at), ("size", size)):
            setattr(self, name, np.insert(getattr(self, name), place, values))

    def _others(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Places of units that aren't the ones kept under their hashes. Up to 8 bytes, equal size and hash are equal bytes."""
        differs = size != self.size[rows]
        long = np.flatnonzero(~differs & (size > 8))
        unequal = data[spread(start[long], size[long])] != self.raw[spread(self.raw_at[rows[long]].astype(np.int64), size[long])]
        if unequal.any():
            differs[np.repeat(long, size[long])[unequal]] = True
        return np.flatnonzero(differs)

    def ids(self, data: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the units one after the other, and how many each unit has."""
        if not len(start):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        if len(self.keys) > self.most or self.used > 8 * self.most:
            self.clear()
        unique, where, back = np.unique(SpanHash(data).of(start, end), return_index=True, return_inverse=True)
        place = np.searchsorted(self.keys, unique)
        known = place < len(self.keys)
        known[known] = self.keys[place[known]] == unique[known]
        missing = np.flatnonzero(~known)
        if len(missing):
            self._add(place[missing], unique[missing], data, start[where[missing]], end[where[missing]])
            place = np.searchsorted(self.keys, unique)
        rows = place[back]
        at, length = self.at[rows], self.length[rows].astype(np.int64)
        others = self._others(data, start, end - start, rows)
        if len(others):
            at[others], length[others] = self._store(self._encode(data, start[others], end[others]))
        return self.flat[spread(at, length)], length


def spread(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Every place of the given runs, one run after the other."""
    total = np.cumsum(size)
    return np.repeat(start - (total - size), size) + np.arange(total[-1] if len(total) else 0)


def _appended(held: np.ndarray, used: int, new: np.ndarray) -> tuple[np.ndarray, int]:
    """An array with room to grow, after `new` is put behind its first `used` values, and how many it now has."""
    if used + len(new) > len(held):
        held = np.concatenate([held, np.zeros(max(len(new), len(held) // 2), held.dtype)])
    held[used : used + len(new)] = new
    return held, used + len(new)


def encode_texts(
    column: pa.Array, table: UnitTable, encode_text: Callable[[str], list[int]], special: tuple[str, ...], keep_space: bool, lower: bool
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(ids, ids per text) for runs of whole texts, in order; a null text is an empty one."""
    _, sizes = text_buffers(column)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(sizes, sizes[row] + TEXTS_BYTES, "right")) - 1)
        texts = [x or "" for x in column.slice(row, end - row).to_pylist()]
        row = end
        easy = np.array([plain(x, special) for x in texts])
        raw = [(x.lower() if lower else x).encode() if ok else b"" for x, ok in zip(texts, easy, strict=True)]
        offsets = np.zeros(len(raw) + 1, np.int64)
        np.cumsum([len(x) for x in raw], out=offsets[1:])
        data = np.frombuffer(b"".join(raw), np.uint8)
        start, stop = cut(data, offsets, keep_space) if len(data) else (np.zeros(0, np.int64),) * 2
        ids, length = table.ids(data, start, stop)
        ends = np.concatenate(([0], np.cumsum(length)))
        bounds = ends[np.searchsorted(start, offsets)]
        if easy.all():
            yield ids, np.diff(bounds)
        else:
            each = [ids[bounds[i] : bounds[i + 1]] if ok else np.array(encode_text(x), np.int32) for i, (x, ok) in enumerate(zip(texts, easy, strict=True))]
            yield np.concatenate(each), np.array([len(x) for x in each], np.int64)
