"""External induced sorting: suffix arrays with common prefixes of strings far larger than memory.

Everything that grows with the string (its symbols, types, the queues of each symbol, names, results) is an
array of `Disk`: in memory up to a bound, in temporary files of the task beyond it. What is worked on at a time
is a batch of bounded size.

Sorting recurses on named substrings: the substrings between neighbouring leftmost S-type suffixes are sorted by
induction, named in order, and the string of names, at most half as long, is sorted the same way. Its order
seeds the queues, which then carry (suffix, common prefix) tuples through two inductions, ascending for
L-type suffixes and descending for S-type ones.
"""

from __future__ import annotations

import os
import tempfile
from dataclasses import dataclass

import numpy as np

#: Suffixes that are visited at a time, and symbols whose queues are looked through for them.
BATCH, SYMBOLS = 1 << 15, 320
#: Strings of names up to this length are sorted at once in memory, about 40 bytes a name; longer ones by recursion.
SHORT = 1 << 21


class Disk:
    """Arrays that take up to `most` bytes of memory together; further ones are temporary files."""

    def __init__(self, most: int):
        self.left, self.folder, self.files = most, None, 0

    def array(self, n: int, kind) -> np.ndarray:
        size = n * np.dtype(kind).itemsize
        if size <= self.left:
            self.left -= size
            return np.zeros(n, kind)
        if self.folder is None:
            self.folder = tempfile.TemporaryDirectory(prefix="shard-")
        self.files += 1
        return np.memmap(os.path.join(self.folder.name, str(self.files)), kind, "w+", shape=(max(n, 1),))[:n]

    def __enter__(self) -> Disk:
        return self

    def __exit__(self, *_) -> None:
        if self.folder is not None:
            self.folder.cleanup()


def _parts(n: int):
    for a in range(0, n, BATCH):
        yield a, min(a + BATCH, n)


def common_prefix(text: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray | int) -> np.ndarray:
    """Common prefix of suffix pairs, at most `most`, four symbols of 16 bits at a time (two of 32)."""
    most = np.broadcast_to(most, len(a))
    out = np.zeros(len(a), np.int64)
    at_once = 8 // text.itemsize
    whole = np.ndarray((max(len(text) - at_once + 1, 0),), "<u8", text, strides=(text.itemsize,))
    left = np.flatnonzero(most > 0)
    while len(left):
        x, y = a[left] + out[left], b[left] + out[left]
        inside = np.maximum(x, y) < len(whole)
        differ = whole[x[inside]] ^ whole[y[inside]]
        same = np.full(len(differ), at_once)
        unequal = differ > 0
        lowest = differ[unequal] & (~differ[unequal] + np.uint64(1))
        same[unequal] = np.bitwise_count(lowest - np.uint64(1)) // (64 // at_once)
        step = np.zeros(len(left), np.int64)
        step[inside] = same
        at = np.flatnonzero(~inside)
        while len(at):  # at the end of the text, symbol by symbol
            at = at[(np.maximum(x[at], y[at]) + step[at] < len(text)) & (step[at] < at_once)]
            at = at[text[x[at] + step[at]] == text[y[at] + step[at]]]
            step[at] += 1
        out[left] += step
        left = left[(step == at_once) & (out[left] < most[left])]
    return np.minimum(out, most)


def _types(text: np.ndarray, disk: Disk) -> np.ndarray:
    """True for S-type suffixes (less than the one after); the last one is S-type."""
    n = len(text)
    out = disk.array(n, bool)
    out[n - 1] = True
    for end in range(n - 1, 0, -BATCH):
        low = max(0, end - BATCH)
        step = np.diff(text[low : end + 1].astype(np.int64))
        nearest = np.where(step != 0, np.arange(end - low), end - low)
        nearest = np.minimum.accumulate(nearest[::-1])[::-1]
        known = nearest < end - low
        block = np.full(end - low, out[end])
        block[known] = step[nearest[known]] > 0
        out[low:end] = block
    return out


def _starts(counts: np.ndarray, disk: Disk) -> np.ndarray:
    out = disk.array(len(counts) + 1, np.int64)
    np.cumsum(counts, out=out[1:])
    return out


def _count(counts: np.ndarray, symbols: np.ndarray) -> None:
    if len(counts) <= BATCH:
        counts += np.bincount(symbols, minlength=len(counts))
    else:
        np.add.at(counts, symbols, 1)


def _append(heads: np.ndarray, store: np.ndarray, symbols: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Put values behind the queues of their symbols (sorted); their places, and where each symbol begins."""
    begin = np.flatnonzero(np.append(True, symbols[1:] != symbols[:-1]))[: len(symbols)]
    count = np.diff(np.append(begin, len(symbols)))
    at = heads[symbols] + np.arange(len(symbols)) - np.repeat(begin, count)
    store[at] = values
    heads[symbols[begin]] += count
    return at, begin


def _range_min(v: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least value of each v[a..b], both included."""
    power = np.frexp((b - a + 1).astype(np.float64))[1] - 1
    out = np.empty(len(a), v.dtype)
    table, step = v, 1
    for k in range(int(power.max(initial=0)) + 1):
        at = np.flatnonzero(power == k)
        out[at] = np.minimum(table[a[at]], table[b[at] - step + 1])
        table = np.minimum(table[:-step], table[step:]) if step < len(table) else table
        step *= 2
    return out


@dataclass
class Induced:
    """Suffixes in the order they were visited, their common prefixes with the one before, and each symbol's first place."""

    suffixes: np.ndarray
    prefix: np.ndarray | None
    starts: np.ndarray


def _induce(text: np.ndarray, symbols: int, is_s: np.ndarray, want_s: bool, seeds: np.ndarray, seed_prefix: np.ndarray | None, most: int, disk: Disk) -> Induced:
    """Induce the L-type suffixes in ascending order, or the S-type ones in descending order (`want_s`).

    Each symbol has a queue in one array. The queues and the seeds of a symbol are visited in order; the suffix
    before a visited one, if it is wanted, goes behind the queue of its own symbol, and shares one symbol more
    with the tuple before it there than the least common prefix visited in between. A batch ends before
    the first tuple that must come after one that the batch itself pushes.
    """
    top = symbols - 1

    def symbol(at: np.ndarray) -> np.ndarray:
        found = text[at].astype(np.int64)
        return top - found if want_s else found

    narrow = np.uint16 if symbols <= 1 << 16 else np.int64  # 16 bits are sorted by radix
    wanted, seeded = disk.array(symbols, np.int64), disk.array(symbols, np.int64)
    for a, b in _parts(len(text) - 1):
        _count(wanted, symbol(a + np.flatnonzero(is_s[a:b] == want_s)))
    for a, b in _parts(len(seeds)):
        _count(seeded, symbol(seeds[a:b]))
    start, seed_start = _starts(wanted, disk), _starts(seeded, disk)
    heads = disk.array(symbols, np.int64)
    heads[:] = start[:-1]
    store = disk.array(int(start[-1]), seeds.dtype)
    prefix = disk.array(int(start[-1]) + 1, np.uint16) if seed_prefix is not None else None
    pushed, since = (np.zeros(symbols, bool), np.full(symbols, most, np.int64)) if prefix is not None else (None, None)
    c, kind, at = 0, 0, 0
    while c < symbols:
        # What is there to visit next: queue and seeds of c, c + 1, ...
        end = min(symbols, c + SYMBOLS)
        begin, stop = np.empty(2 * (end - c), np.int64), np.empty(2 * (end - c), np.int64)
        begin[0::2], stop[0::2] = start[c:end], heads[c:end]
        begin[1::2], stop[1::2] = seed_start[c:end], seed_start[c + 1 : end + 1]
        begin[kind] = at
        begin[:kind] = stop[:kind]
        size = stop - begin
        total = np.cumsum(size)
        if not total[-1]:
            c, kind = end, 0
            at = int(start[c]) if c < symbols else 0
            continue
        # Segments beyond the batch don't matter.
        used = int(np.searchsorted(total, min(BATCH, total[-1]))) + 1
        segment = np.repeat(np.arange(used), size[:used])[:BATCH]
        place = begin[segment] + np.arange(len(segment)) - (total - size)[segment]
        is_seed = (segment & 1).astype(bool)
        suffix = np.empty(len(segment), np.int64)
        suffix[~is_seed], suffix[is_seed] = store[place[~is_seed]], seeds[place[is_seed]]
        before = suffix - 1
        pushes = (before >= 0) & (is_s[before] == want_s)
        into = symbol(before)
        late = 2 * c + segment[1:] > np.minimum.accumulate(np.where(pushes, 2 * into, 2 * symbols))[:-1]
        many = int(np.argmax(late)) + 1 if late.any() else len(segment)
        use = np.flatnonzero(pushes[:many])
        use = use[np.argsort(into[use].astype(narrow), kind="stable")]
        to = into[use]
        if prefix is None:
            _append(heads, store, to, before[use])
        else:
            v = np.empty(many, np.int64)
            queued = ~is_seed[:many]
            v[queued], v[~queued] = prefix[place[:many][queued]], seed_prefix[place[:many][~queued]]
            own = c + (segment[:many] >> 1)
            for i in np.flatnonzero(~queued & (place[:many] == seed_start[own]) & (heads[own] > start[own])).tolist():
                v[i] = common_prefix(text, store[heads[own[i : i + 1]] - 1].astype(np.int64), suffix[i : i + 1], most)[0]
            where, first = _append(heads, store, to, before[use])
            last = np.append(first[1:], len(use)) - 1 if len(use) else first
            previous = np.append(-1, use[:-1])[: len(use)]
            previous[first] = -1
            low = _range_min(v, previous + 1, use)
            shared = low + 1
            shared[first] = np.where(pushed[to[first]], np.minimum(since[to[first]], low[first]) + 1, 0)
            prefix[where] = np.minimum(shared, most)
            np.minimum(since, v.min(), out=since)
            rest = np.append(np.minimum.accumulate(v[::-1])[::-1], most)
            since[to[last]] = rest[use[last] + 1]
            pushed[to[first]] = True
        c, kind, at = c + (int(segment[many - 1]) >> 1), int(segment[many - 1]) & 1, int(place[many - 1]) + 1
    return Induced(store, prefix, start)


def _first_queues(text: np.ndarray, symbols: int, places: np.ndarray, disk: Disk) -> np.ndarray:
    """Places dealt into the queues of their symbols, in order of arrival."""
    counts = disk.array(symbols, np.int64)
    for a, b in _parts(len(places)):
        _count(counts, text[places[a:b]].astype(np.int64))
    heads = disk.array(symbols, np.int64)
    heads[:] = _starts(counts, disk)[:-1]
    out = disk.array(len(places), places.dtype)
    for a, b in _parts(len(places)):
        symbol = text[places[a:b]].astype(np.int64)
        order = np.argsort(symbol, kind="stable")
        _append(heads, out, symbol[order], places[a:b][order])
    return out


def _seed_places(is_s: np.ndarray, kind, disk: Disk) -> np.ndarray:
    """The leftmost S-type suffixes from left to right."""
    found = [a + 1 + np.flatnonzero(is_s[a + 1 : b + 1] & ~is_s[a:b]) for a, b in _parts(len(is_s) - 1)] if len(is_s) <= BATCH else None
    if found is not None:
        return np.concatenate(found).astype(kind)
    out, n = disk.array(sum(int((is_s[a + 1 : b + 1] & ~is_s[a:b]).sum()) for a, b in _parts(len(is_s) - 1)), kind), 0
    for a, b in _parts(len(is_s) - 1):
        some = a + 1 + np.flatnonzero(is_s[a + 1 : b + 1] & ~is_s[a:b])
        out[n : n + len(some)] = some
        n += len(some)
    return out


def _sorted_seeds(text: np.ndarray, symbols: int, is_s: np.ndarray, reach: int, disk: Disk) -> np.ndarray:
    """The leftmost S-type suffixes in order: their substrings sorted by induction and named, then the string of names by recursion."""
    kind = np.int32 if len(text) < 2**31 else np.int64
    places = _seed_places(is_s, kind, disk)
    large = _induce(text, symbols, is_s, False, _first_queues(text, symbols, places, disk), None, 0, disk)
    small = _induce(text, symbols, is_s, True, large.suffixes[::-1], None, 0, disk).suffixes[::-1]
    by_substring, n = disk.array(len(places), kind), 1
    by_substring[0] = len(text) - 1
    for a, b in _parts(len(small)):
        some = small[a:b]
        some = some[(some > 0) & ~is_s[some - 1]]
        by_substring[n : n + len(some)] = some
        n += len(some)
    rank = disk.array(len(text), kind)
    for a, b in _parts(len(places)):
        rank[places[a:b]] = np.arange(a, b)
    names, last_name = disk.array(len(places), np.uint32), 0
    before, before_size = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for a, b in _parts(len(places)):
        own = by_substring[a:b].astype(np.int64)
        row = rank[own].astype(np.int64)
        size = places[np.minimum(row + 1, len(places) - 1)] - own + 1
        x, xs = np.append(before, own[:-1]), np.append(before_size, size[:-1])
        y, ys = (own, size) if a else (own[1:], size[1:])
        same = xs == ys
        at = np.flatnonzero(same)
        same[at] = common_prefix(text, x[at], y[at], ys[at]) == ys[at]
        new = np.cumsum(~same) + last_name
        names[row] = new if a else np.append(0, new)
        last_name = int(new[-1]) if len(new) else last_name
        before, before_size = own[-1:], size[-1:]
    if last_name + 1 == len(places):
        return by_substring
    order = suffix_array(names, last_name + 1, reach, disk, named=True)[0]
    out = by_substring
    for a, b in _parts(len(order)):
        out[a:b] = places[order[a:b]]
    return out


def _sorted_at_once(text: np.ndarray, enough: int) -> np.ndarray:
    """Suffixes of a short string in order as far as `enough` symbols tell, by ranks of twice the length each time."""
    rank = np.unique(text, return_inverse=True)[1]
    step = 1
    while step < enough and rank.max() + 1 < len(text):
        following = np.zeros(len(text), np.int64)
        following[:-step] = rank[step:] + 1
        rank = np.unique(rank * (len(text) + 1) + following, return_inverse=True)[1]
        step *= 2
    return np.argsort(rank, kind="stable")


def suffix_array(text: np.ndarray, symbols: int, reach: int, disk: Disk, named: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
    """Suffixes of a string of 0..symbols-1 in order, and each one's common prefix with the one before, up to `reach`.

    The string ends in a 0, its only one. Suffixes that agree in `reach` symbols may come in any order. For a string
    of names no common prefixes are made.
    """
    n = len(text)
    kind = np.int32 if n < 2**31 else np.int64
    if named and n <= SHORT:
        return _sorted_at_once(text, reach).astype(kind), None
    order, shared = disk.array(n, kind), None if named else disk.array(n, np.uint16)
    order[0] = n - 1
    if n == 1:
        return order, shared
    is_s = _types(text, disk)
    seeds, seed_prefix = _sorted_seeds(text, symbols, is_s, reach, disk), None
    if not named:
        seed_prefix = disk.array(len(seeds), np.uint16)
        for a, b in _parts(len(seeds) - 1):
            some = seeds[a : b + 1].astype(np.int64)
            seed_prefix[a + 1 : b + 1] = common_prefix(text, some[:-1], some[1:], reach)
    large = _induce(text, symbols, is_s, False, seeds, seed_prefix, reach, disk)
    small = _induce(text, symbols, is_s, True, large.suffixes[::-1], None if named else large.prefix[::-1], reach, disk)
    # Both kinds in one row: of each symbol first the L-type suffixes, then the S-type ones.
    small_starts = 1 + small.starts[-1] - small.starts[::-1]
    for a, b in _parts(len(large.suffixes)):
        at = a + np.arange(b - a) + small_starts[text[large.suffixes[a:b]].astype(np.int64)]
        order[at] = large.suffixes[a:b]
        if not named:
            shared[at] = large.prefix[a:b]
    for a, b in _parts(len(small.suffixes)):
        some = small.suffixes[::-1][a:b]
        at = 1 + a + np.arange(b - a) + large.starts[text[some].astype(np.int64) + 1]
        order[at] = some
        if not named:
            shared[at] = small.prefix[::-1][a:b]
    if not named:
        both = np.flatnonzero((np.diff(large.starts) > 0) & (np.diff(small_starts) > 0))
        border = small_starts[both] + large.starts[both + 1]
        shared[border] = common_prefix(text, order[border - 1].astype(np.int64), order[border].astype(np.int64), reach)
    return order, shared
