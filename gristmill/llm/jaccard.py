"""N-gram Jaccard join by universe partition and pigeonhole, verified exactly.

Two sets whose Jaccard similarity reaches the threshold differ in at most H elements. The universe of
element hashes is partitioned into segments, more than H by weight, so some segment must agree:

* Size bands. Sets are grouped by size; a scheme (number of segments) belongs to the band of the
  smaller set, and a set takes part in its own band's scheme and, near the border, in the band below.
* Segment subsets. A segment of weight 1 is indexed by the hash of the elements that fall into it.
* One-deletion neighbourhoods. A segment of weight 2 is indexed by itself and by itself less each
  element, so it also finds partners that differ by one element there.
* Cost-based allocation. The share of weight-2 segments minimises expected index and list sizes of the
  band. Segments with fewest elements have the longest lists; each set leaves out as many of them
  as the pigeonhole bound for its size leaves over. With one order for all sets no pair is lost: a
  similar pair agrees in more segments than either side leaves out, and the last of them in that
  order is left out by neither.

Members of a key are first held against each other by size and by a parity mark, which rule out pairs
without losing one. What is left forms candidate components, whose texts meet once to be
verified by sorted 64-bit shingle hashes. Equal sets (by 128-bit fingerprints) are one node from the start.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, SpanHash, chunks, discard, mix, ngram_hash, release_memory, stored, word_spans
from .graph import components

#: Each band's largest size is this many times its smallest.
BAND_RATIO = 2.0
#: Sets of one key, and elements of one candidate component, that one task settles; larger groups are dealt over tasks.
KEY_ROWS, CELL_ELEMENTS = 1 << 15, 1 << 20
#: Index entries that one task sorts; a bucket of more (a key of very many sets) is dealt over tasks.
BUCKET_ENTRIES = 1 << 22
#: Nodes outside the largest part of such a group that one task holds against a block of it: of a key's sets, by their marks, and of a candidate
#: component, by their texts. Members are repeated once for so many nodes.
LEFT_MARKS, LEFT_ROWS = 1 << 14, 1000
#: Bits of a mark for each element of its set, at least: where marks travel, and where a task makes them.
NARROW, WIDE = 0.8, 4.0


def word_sets(column: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each whole text (A-Z lower-cased); no words, no elements."""
    for _, _, data, offsets in chunks(column):
        data = LOWER[data]
        start, end, bounds = word_spans(data, offsets)
        h = SpanHash(data).of(start, end) if len(start) else np.zeros(0, np.uint64)
        grams, _ = ngram_hash(h, bounds, words)
        counts = np.diff(bounds)
        at = np.concatenate(([0], np.cumsum(np.maximum(counts - words + 1, 0))))
        for i, n in enumerate(counts):
            if n >= words:
                yield np.unique(grams[at[i] : at[i + 1]])
            elif n:
                yield mix(ngram_hash(h, bounds[i : i + 2], int(n))[0] + np.uint64(n))
            else:
                yield np.zeros(0, np.uint64)


def digest_of(elements: np.ndarray) -> tuple[int, int]:
    """128-bit fingerprint of a set, as two signed numbers."""
    raw = hashlib.blake2b(elements.tobytes(), digest_size=16).digest()
    return int.from_bytes(raw[:8], "little", signed=True), int.from_bytes(raw[8:], "little", signed=True)


def most_difference(a: int, b: int, percent: int) -> int:
    """Greatest symmetric difference of similar sets of sizes a and b: |a∩b| ≥ t/(1+t) (a+b)."""
    shared = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * shared


@lru_cache(maxsize=None)
def most_between(low: int, high: int, percent: int) -> int:
    """Greatest symmetric difference of similar sets whose sizes add up to low..high: it isn't monotone in the sum."""
    total = np.arange(max(low, high - 4 * (100 + percent)), high + 1)
    return int((total - 2 * -(-percent * total // (100 + percent))).max())


@lru_cache(maxsize=None)
def band_of(size: int) -> tuple[int, int, int]:
    """(number, smallest size, largest size) of the band of a size."""
    low, k = 1, 0
    while True:
        high = max(low, int(low * BAND_RATIO) - 1)
        if size <= high:
            return k, low, high
        low, k = high + 1, k + 1


@lru_cache(maxsize=None)
def scheme(band: int, low: int, high: int, percent: int) -> tuple[int, int]:
    """(weight-1 segments, weight-2 segments) of a band.

    Their weight exceeds the greatest difference of the band by a few, so that short segments can be
    left out. Weight-2 segments are taken while they lower the expected cost: index keys plus, for each
    list, the chance that a segment is too poor in elements to tell sets apart.
    """
    weight = most_between(2 * low, high + high * 100 // percent, percent) + 1 + (2 if high > 6 else 0)
    best, choice = None, (weight, 0)
    for twice in range(weight // 2 + 1):
        once = weight - 2 * twice
        per_unit = (low + high) / 2 / weight
        keys = once + twice * (1 + 2 * per_unit)
        poor = once * np.exp(-per_unit) + twice * (1 + 2 * per_unit) * np.exp(-2 * per_unit)
        cost = keys + 20 * poor
        if best is None or cost < best - 1e-9:
            best, choice = cost, (once, twice)
    return choice


def index_keys(elements: np.ndarray, percent: int) -> np.ndarray:
    """Index keys of one set under all its schemes."""
    n = len(elements)
    if not n:
        return np.zeros(0, np.uint64)
    own = band_of(n)
    # Partners that a set meets in a scheme: the smaller of a pair is of the scheme's band.
    smallest = -(-n * percent // 100)
    wanted = [(own, most_between(n + max(own[1], smallest), n + n * 100 // percent, percent))]
    if own[0]:
        below = band_of(own[1] - 1)
        if n <= below[2] * 100 // percent:
            wanted.append((below, most_between(n + max(below[1], smallest), n + below[2], percent)))
    out = []
    for band, most in wanted:
        once, twice = scheme(*band, percent)
        weight = once + 2 * twice
        salt = np.uint64((band[0] + 1) * 0x9E3779B97F4A7C15 & (2**64 - 1))
        slot = ((elements >> np.uint64(11)) % np.uint64(weight)).astype(np.int64)
        segment = np.where(slot < once, slot, once + (slot - once) // 2)
        total = np.zeros(once + twice, np.uint64)
        spread = mix(elements ^ salt)
        np.add.at(total, segment, spread)
        count = np.bincount(segment, minlength=once + twice)
        place = mix(np.arange(once + twice, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93) + salt)
        single = mix(total[:once] + place[:once])
        spare = max(0, weight - 1 - most)
        if spare:
            order = np.lexsort((single, count[:once]))
            single = single[order[min(spare, once) :]]
        out.append(single)
        if twice:
            out.append(mix(total[once:] + place[once:]))
            deep = np.flatnonzero(segment >= once)
            out.append(mix(total[segment[deep]] - spread[deep] + place[segment[deep]]))
    return np.concatenate(out)


def _emit(words: int, percent: int, buckets: int):
    """Per batch of documents: its rows, and its index entries packed by bucket, 14 bytes each (48 bits of the key, the set).

    `ord` numbers the rows of the whole table; equal sets of a batch are indexed once. `n` is a row's set size, or the number of packed entries.
    """

    def run(batches):
        base = TaskContext.get().partitionId() << 33
        for batch in batches:
            rows = {name: [] for name in ("n", "node", "twin", "mark")}
            keys, nodes, counts, known = [], [], [], {}
            for elements in word_sets(batch.column(1), words):
                pair = digest_of(elements)
                if len(elements) and pair not in known:
                    known[pair] = parity_marks(elements, NARROW).tobytes()
                    k = index_keys(elements, percent)
                    keys.append(k)
                    nodes.append(pair[0])
                    counts.append(len(k))
                for name, value in zip(rows, (len(elements), *pair, known.get(pair)), strict=True):
                    rows[name].append(value)
            m = batch.num_rows
            rows |= {"doc_id": batch.column(0), "row": batch.column(2), "ord": np.arange(base, base + m), "bucket": pa.nulls(m, pa.int32()), "keys": pa.nulls(m, pa.binary()), "nodes": pa.nulls(m, pa.binary())}
            base += m
            yield pa.RecordBatch.from_pydict({f.name: rows[f.name] for f in EMITTED}, schema=EMITTED)
            if keys:
                key, node = np.concatenate(keys) & np.uint64(2**48 - 1), np.repeat(np.array(nodes, np.int64), counts)
                at = (key % np.uint64(buckets)).astype(np.int64)
                order = np.argsort(at, kind="stable")
                key, node = key[order], node[order]
                cuts = np.searchsorted(at[order], np.arange(buckets + 1))
                some = np.flatnonzero(np.diff(cuts)).tolist()
                packed = {f.name: pa.nulls(len(some), f.type) for f in EMITTED}
                packed["bucket"] = pa.array(some, pa.int32())
                packed["n"] = pa.array([int(cuts[x + 1] - cuts[x]) for x in some], pa.int64())
                packed["keys"] = pa.array([_six_bytes(key[cuts[x] : cuts[x + 1]]) for x in some], pa.binary())
                packed["nodes"] = pa.array([node[cuts[x] : cuts[x + 1]].tobytes() for x in some], pa.binary())
                yield pa.RecordBatch.from_pydict(packed, schema=EMITTED)
                del key, node, at, order, packed
            del rows, keys, nodes, known
            release_memory()

    return run


EMITTED = pa.schema([("doc_id", pa.int64()), ("n", pa.int64()), ("node", pa.int64()), ("twin", pa.int64()), ("mark", pa.binary()), ("row", pa.int64()), ("ord", pa.int64()), ("bucket", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])


def _six_bytes(key: np.ndarray) -> bytes:
    return np.ascontiguousarray(key.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


MEMBERS = pa.schema([("grp", pa.int64()), ("node", pa.int64()), ("size", pa.int64())])


def _entries(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """(key, set) of packed entries."""
    raw = np.frombuffer(b"".join(table.column("keys").to_pylist()), np.uint8).reshape(-1, 6)
    key = np.zeros((len(raw), 8), np.uint8)
    key[:, :6] = raw
    return key.view("<i8").ravel(), np.frombuffer(b"".join(table.column("nodes").to_pylist()), np.int64)


def _distinct(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (key, set) pairs in order, and where each key begins."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.append(True, (key[1:] != key[:-1]) | (node[1:] != node[:-1]))[: len(key)]
    key, node = key[new], node[new]
    return key, node, np.flatnonzero(np.append(True, key[1:] != key[:-1])[: len(key)])


def _shared_keys(table: pa.Table) -> pa.Table:
    """Of one bucket: the (key, set, sets of the key) rows of keys that two sets or more have."""
    key, node = _entries(table)
    order = np.argsort(key)
    begin = np.flatnonzero(np.append(True, key[order][1:] != key[order][:-1]))
    uses = np.diff(np.append(begin, len(order)))
    order = order[np.repeat(uses > 1, uses)]
    key, node, begin = _distinct(key[order], node[order])
    size = np.diff(np.append(begin, len(key)))
    size = np.repeat(size, size)
    del order, uses
    release_memory()
    return pa.table({"grp": key[size > 1], "node": node[size > 1], "size": size[size > 1]}, schema=MEMBERS)


def _deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Packed entries of large buckets, dealt over `parts` by their set; a set's own entries stay together."""
    schema = pa.schema([("bucket", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("nodes", pa.binary())])
    for batch in batches:
        out = {f.name: [] for f in schema}
        for bucket, parts, keys, nodes in zip(*(batch.column(c).to_pylist() for c in ("bucket", "parts", "keys", "nodes")), strict=True):
            key, node = np.frombuffer(keys, np.uint8).reshape(-1, 6), np.frombuffer(nodes, np.int64)
            part = node % parts
            order = np.argsort(part, kind="stable")
            cuts = np.searchsorted(part[order], np.arange(parts + 1))
            for x in np.flatnonzero(np.diff(cuts)).tolist():
                some = order[cuts[x] : cuts[x + 1]]
                for values, value in zip(out.values(), (bucket, x, key[some].tobytes(), node[some].tobytes()), strict=True):
                    values.append(value)
        yield pa.RecordBatch.from_pydict(out, schema=schema)


def _count_keys(place: tuple, table: pa.Table) -> pa.Table:
    """Of one part of a bucket: the number of sets of each key."""
    key, _, begin = _distinct(*_entries(table))
    bucket, part = (np.full(len(begin), x.as_py(), np.int32) for x in place)
    return pa.table({"bucket": bucket, "part": part, "grp": key[begin], "n": np.diff(np.append(begin, len(key)))})


def _of_shared_keys(table: pa.Table, shared: pa.Table) -> pa.Table:
    """Of one part of a bucket: its rows of the keys that are shared, with their sizes in the whole bucket."""
    key, node, begin = _distinct(*_entries(table))
    wanted, size = (shared.column(c).to_numpy() for c in ("grp", "size"))
    order = np.argsort(wanted)
    wanted, size = wanted[order], size[order]
    at = np.searchsorted(wanted, key)
    at[at == len(wanted)] = 0
    keep = wanted[at] == key if len(wanted) else np.zeros(len(key), bool)
    return pa.table({"grp": key[keep], "node": node[keep], "size": size[at[keep]]}, schema=MEMBERS)


def _members(entries: DataFrame) -> DataFrame:
    """(grp, node, size), stored: the sets of every key that two sets or more have.

    A bucket is settled in one task; one of more than BUCKET_ENTRIES is dealt over tasks by set. There
    each part counts its sets of a key, the counts are added up, and each part gets the sums of its keys. There are
    no more buckets than shuffle partitions, so the list of the large ones may be broadcast.
    """
    kind = "grp long, node long, size long"
    parts = entries.groupBy("bucket").agg(F.ceil(F.sum("n") / BUCKET_ENTRIES).cast("int").alias("parts")).where("parts > 1")
    parts = stored(parts, "large-buckets")
    if not parts.take(1):
        members = stored(entries.groupBy("bucket").applyInArrow(_shared_keys, kind), "members")
        discard(parts)
        return members
    own = F.broadcast(parts)
    whole = entries.join(own, "bucket", "left_anti").groupBy("bucket").applyInArrow(_shared_keys, kind)
    dealt = stored(entries.join(own, "bucket").select("bucket", "parts", "keys", "nodes").mapInArrow(_deal, "bucket int, part int, keys binary, nodes binary"), "dealt")
    counts = stored(dealt.groupBy("bucket", "part").applyInArrow(_count_keys, "bucket int, part int, grp long, n long"), "key-counts")
    sizes = counts.groupBy("grp").agg(F.sum("n").alias("size")).where("size > 1")
    shared = counts.join(sizes, "grp").select("bucket", "part", "grp", "size")
    split = dealt.groupBy("bucket", "part").cogroup(shared.groupBy("bucket", "part")).applyInArrow(_of_shared_keys, kind)
    members = stored(whole.unionByName(split), "members")
    discard(parts, dealt, counts)
    return members


def parity_marks(elements: np.ndarray, per_element: float) -> np.ndarray:
    """Bits that each element flips at its own place: sets differ in at least as many elements as marks in bits.

    The number of bits is a power of two; a wider mark folds to a narrower one by xor of its halves.
    """
    words = 1
    while words * 64 < per_element * len(elements):
        words *= 2
    at = (mix(elements) >> np.uint64(20)) % np.uint64(64 * words)
    odd = np.bincount(at.astype(np.int64), minlength=64 * words) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.uint64)


class Marks:
    """Marks of several nodes, compared in pairs at the narrower width."""

    def __init__(self, raw: list[bytes]):
        self.width = np.array([len(r) // 8 for r in raw])
        self.folded = {}
        for w in np.unique(self.width).tolist():
            table = np.zeros((len(raw), w), np.uint64)
            for i in np.flatnonzero(self.width >= w):
                table[i] = np.bitwise_xor.reduce(np.frombuffer(raw[i], np.uint64).reshape(-1, w), axis=0)
            self.folded[w] = table

    def least_difference(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        out = np.empty(len(i), np.int64)
        narrow = np.minimum(self.width[i], self.width[j])
        for w in np.unique(narrow).tolist():
            at = np.flatnonzero(narrow == w)
            table = self.folded[w]
            for part in np.array_split(at, max(1, len(at) * w // 500_000)):
                out[part] = np.bitwise_count(table[i[part]] ^ table[j[part]]).sum(1)
        return out


# --- relating the members of groups --------------------------------------------------------------


#: Part of a row in its cell: held against others while outside the largest part; against all others; only as the other.
OWN, HEAD, MEMBER = 0, 1, 2
#: Heads of a group that is dealt over several cells.
HEADS = 8


def _joined(m: int, side: np.ndarray, compare: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """Links that join what is related among m members of one group, no more than there are members.

    A head is held against all members that aren't joined to it yet. OWN members become heads until all that
    weren't are in one part, the largest: so of two members that end up apart one was a head.
    """
    part = np.arange(m)
    size = np.ones(m, np.int64)
    waiting = side != MEMBER
    always = side == HEAD
    done = np.zeros(m, bool)
    links = []
    while True:
        heads = waiting & (always | (part != np.argmax(size)))
        if not heads.any():
            return links
        x = int(np.argmax(heads))
        waiting[x] = False
        others = np.flatnonzero((part != part[x]) & ~done)
        done[x] = True
        if len(others):
            for y in others[compare(x, others)].tolist():
                if part[y] != part[x]:
                    links.append((x, y))
                    size[part[x]] += size[part[y]]
                    size[part[y]] = 0
                    part[part == part[y]] = part[x]


def _local_roots(m: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of each member's component."""
    root = np.arange(m)
    while True:
        low = np.minimum(root[a], root[b])
        before = root.copy()
        np.minimum.at(root, root[a], low)
        np.minimum.at(root, root[b], low)
        root = root[root]
        if (root == before).all():
            return root


def _cell(settle: Callable):
    """Links of one cell. `settle` gets its rows sorted by group, node and side, and gives pairs of rows."""

    def run(table: pa.Table) -> pa.Table:
        grp, node, side = (table.column(c).to_numpy() for c in ("grp", "node", "side"))
        order = np.lexsort((side, node, grp))
        i, j = settle(table.take(pa.array(order)), grp[order], node[order], side[order])
        names, at = np.unique(node[order], return_inverse=True)
        root = _local_roots(len(names), at[i], at[j])
        moved = np.flatnonzero(root != np.arange(len(names)))
        release_memory()
        return pa.table({"a": names[moved], "b": names[root[moved]]}, schema=pa.schema([("a", pa.int64()), ("b", pa.int64())]))

    return run


def _once(grp: np.ndarray, node: np.ndarray) -> np.ndarray:
    """Places of the first row of each (group, node), of sorted rows."""
    return np.flatnonzero(np.append(True, (grp[1:] != grp[:-1]) | (node[1:] != node[:-1]))[: len(grp)])


def _groups(grp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    begin = np.flatnonzero(np.append(True, grp[1:] != grp[:-1])[: len(grp)])
    return begin, np.append(begin[1:], len(grp))[: len(begin)]


def _by_marks(percent: int):
    """Relation of members of a key: sizes and marks don't rule out that their sets are similar."""

    def near(marks: Marks, n: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        total = n[i] + n[j]
        shared = -(-percent * total // (100 + percent))
        fits = np.flatnonzero(shared <= np.minimum(n[i], n[j]))
        out = np.zeros(len(i), bool)
        out[fits] = marks.least_difference(i[fits], j[fits]) <= (total - 2 * shared)[fits]
        return out

    def settle(table: pa.Table, grp: np.ndarray, node: np.ndarray, side: np.ndarray):
        at = _once(grp, node)
        grp, side = grp[at], side[at]
        n = table.column("n").to_numpy()[at].astype(np.int64)
        marks = Marks(table.column("mark").take(pa.array(at)).to_pylist())
        begin, end = _groups(grp)
        lefts, rights = [], []
        # Pairs of small groups at once, one offset after the other; larger groups head by head.
        small = np.repeat(end - begin <= 12, end - begin)
        last = np.repeat(end, end - begin)
        for step in range(1, 12):
            i = np.flatnonzero(small & (np.arange(len(grp)) + step < last))
            if not len(i):
                break
            i = i[~((side[i] == MEMBER) & (side[i + step] == MEMBER))]
            keep = i[near(marks, n, i, i + step)]
            lefts.append(keep)
            rights.append(keep + step)
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            if b - a > 12:
                pairs = _joined(b - a, side[a:b], lambda x, others, a=a: near(marks, n, np.full(len(others), a + x), a + others))
                lefts.append(np.array([x for x, _ in pairs], np.int64) + a)
                rights.append(np.array([y for _, y in pairs], np.int64) + a)
        none = [np.zeros(0, np.int64)]
        return at[np.concatenate(lefts + none)], at[np.concatenate(rights + none)]

    return settle


def _by_sets(words: int, percent: int):
    """Relation of members of a candidate component: their sets, made from the texts, are similar."""

    def settle(table: pa.Table, grp: np.ndarray, node: np.ndarray, side: np.ndarray):
        sets = list(word_sets(table.column("text"), words))
        n = np.array([len(x) for x in sets])
        # A text that came by another row's key isn't of this set.
        real = [digest_of(x) == (d1, d2) for x, d1, d2 in zip(sets, table.column("digest").to_pylist(), table.column("twin").to_pylist(), strict=True)]
        at = np.flatnonzero(real)
        at = at[_once(grp[at], node[at])]
        lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        begin, end = _groups(grp[at])
        for a, b in zip(begin.tolist(), end.tolist(), strict=True):
            rows = at[a:b]
            own, count = [sets[i] for i in rows.tolist()], n[rows]
            marks = Marks([parity_marks(x, WIDE).tobytes() for x in own]) if b - a > 8 else None

            def similar(x: int, others: np.ndarray, own=own, count=count, marks=marks) -> np.ndarray:
                total = count[others] + count[x]
                shared = -(-percent * total // (100 + percent))
                out = np.zeros(len(others), bool)
                left = np.flatnonzero(shared <= np.minimum(count[others], count[x]))
                if marks is not None:
                    left = left[marks.least_difference(np.full(len(left), x), others[left]) <= (total - 2 * shared)[left]]
                for part in np.array_split(left, max(1, int(count[others[left]].sum()) // 1_000_000)):
                    if len(part):
                        each = np.concatenate([own[i] for i in others[part].tolist()])
                        place = np.searchsorted(own[x], each)
                        place[place == count[x]] = 0
                        bounds = np.concatenate(([0], np.cumsum(count[others[part]])[:-1]))
                        both = np.add.reduceat((own[x][place] == each).astype(np.int64), bounds)
                        out[part] = 100 * both >= percent * (total[part] - both)
                return out

            pairs = _joined(b - a, side[rows], similar)
            lefts.append(rows[[x for x, _ in pairs]])
            rights.append(rows[[y for _, y in pairs]])
        return np.concatenate(lefts), np.concatenate(rights)

    return settle


def _related(rows: DataFrame, sizes: DataFrame, settle: Callable, most: int, cells: int, left: int) -> list[DataFrame]:
    """(a, b) links that join the related nodes of every group, in one or two tables.

    `rows` has grp, node, size (of the whole group, in any unit) and what `settle` reads; `sizes` has all their sizes. Groups up to `most` are
    settled whole, many to a cell. A larger one is dealt over cells by node; each cell also gets the group's
    heads, so members related to one of them are joined in linear work. Nodes that stay outside the
    group's largest part are then held against all its nodes, a block of them in each cell.
    """
    kind = "a long, b long"
    cell = F.col("cell")
    whole = rows.where(F.col("size") <= most).withColumn("side", F.lit(OWN)).withColumn("cell", F.pmod(F.xxhash64("grp"), F.lit(cells)))
    out = [whole.groupBy(cell).applyInArrow(_cell(settle), kind)]
    if not sizes.where(F.col("size") > most).take(1):
        return out
    large = rows.where(F.col("size") > most)
    blocks = F.ceil(F.col("size") / most).cast("int")
    members = large.withColumn("block", F.pmod(F.xxhash64("node"), blocks)).withColumn("side", F.lit(MEMBER))
    heads = large.groupBy("grp", F.pmod(F.xxhash64("node"), F.lit(HEADS)).alias("slot")).agg(F.min("node").alias("node")).select("grp", "node")
    heads = large.join(heads, ["grp", "node"]).withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("side", F.lit(HEAD))
    dealt = members.unionByName(heads).withColumn("cell", F.xxhash64("grp", "block"))
    first = stored(dealt.groupBy(cell).applyInArrow(_cell(settle), kind), "links")
    parts = components(first)
    placed = large.select("grp", "node").join(parts, "node", "left").select("grp", "node", F.coalesce("component", "node").alias("part"))
    core = placed.groupBy("grp", "part").agg(F.count("*").alias("many")).groupBy("grp").agg(F.max_by("part", F.struct("many", "part")).alias("core"))
    outside = stored(placed.join(core, "grp").where("part <> core").select("grp", "node"), "outside")
    out.append(first)
    if outside.take(1):
        own = large.join(outside, ["grp", "node"])
        sizes = outside.groupBy("grp").agg(F.count("*").alias("left"))
        slices = F.ceil(F.col("left") / left).cast("int")
        own = own.join(sizes, "grp").withColumn("slice", F.pmod(F.xxhash64("node", F.lit(1)), slices)).drop("left")
        own = own.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))).withColumn("side", F.lit(HEAD))
        every = members.join(sizes, "grp").withColumn("slice", F.explode(F.sequence(F.lit(0), slices - 1))).drop("left")
        dealt = every.unionByName(own).withColumn("cell", F.xxhash64("grp", "block", "slice"))
        out.append(stored(dealt.groupBy(cell).applyInArrow(_cell(settle), kind), "links"))
    discard(outside, parts)
    return out


def _row_key(documents: DataFrame) -> Column:
    """64-bit key of a row's doc_id and text, never null; rows equal in both share it."""
    return F.xxhash64(documents["doc_id"].cast("long"), documents["text"].cast("string"))


def _row_classes(documents: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, row, class) of every document, stored; the class is the number of a row of its component."""
    if percent <= 100 / BAND_RATIO:
        raise ValueError(f"percent must exceed {100 / BAND_RATIO:g}: partners further apart than one size band aren't searched")
    spark = documents.sparkSession
    docs = documents.select(documents["doc_id"].cast("long").alias("doc_id"), documents["text"].cast("string").alias("text"))
    keyed = docs.withColumn("row", _row_key(docs))
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    emitted = stored(keyed.mapInArrow(_emit(words, percent, buckets), "doc_id long, n long, node long, twin long, mark binary, row long, ord long, bucket int, keys binary, nodes binary"), "entries")
    nodes = stored(emitted.where("bucket IS NULL").drop("bucket", "keys", "nodes"), "nodes")
    members = _members(emitted.where("bucket IS NOT NULL").select("bucket", "n", "keys", "nodes"))
    discard(emitted)
    # One representative of each set: the least of its rows, and for the text a row that is alone in its key if there is one.
    by_row = nodes.where("n > 0").groupBy("node", "twin", "row").agg(F.count("*").alias("times"), F.min("ord").alias("rep"), F.first("n").alias("n"), F.first("mark").alias("mark"))
    reps = by_row.groupBy("node", "twin").agg(F.min("rep").alias("rep"), F.min(F.struct("times", "row")).alias("text_row"), F.first("n").alias("n"), F.first("mark").alias("mark"))
    reps = stored(reps.select("node", "twin", "rep", "text_row.row", "text_row.times", "n", "mark"), "sets")
    marked = members.join(reps.select("node", "rep", "n", "mark"), "node").select("grp", F.col("rep").alias("node"), "size", "n", "mark")
    near = _related(marked, members, _by_marks(percent), KEY_ROWS, 2 * buckets, LEFT_MARKS)
    candidates = components(_union(near))
    described = candidates.join(reps.withColumnRenamed("node", "digest"), F.col("node") == F.col("rep"))
    described = described.select(F.col("component").alias("grp"), "node", "digest", "twin", "row", "times", "n")
    sizes = described.groupBy("grp").agg(F.sum("n").alias("size"))
    wanted = stored(described.join(sizes, "grp").drop("n"), "candidates")
    elements = sizes.agg(F.sum("size")).first()[0] or 0
    discard(members, candidates, *near)
    linked = _related(_with_texts(docs, wanted), wanted, _by_sets(words, percent), CELL_ELEMENTS, max(buckets, int(elements // CELL_ELEMENTS) + 1), LEFT_ROWS)
    joined = components(_union(linked))
    classes = reps.select("node", "twin", "rep").join(joined.select(F.col("node").alias("rep"), "component"), "rep", "left").select("node", "twin", F.coalesce("component", "rep").alias("class"))
    classes = stored(classes, "set-classes")
    by_node = nodes.join(classes, ["node", "twin"], "left").select("doc_id", "n", "row", F.coalesce("class", "ord").alias("class"))
    by_node = stored(by_node, "classes")
    discard(nodes, reps, wanted, joined, classes, *linked)
    return by_node


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _with_texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted sets with the text of one of their rows each.

    The list of rows grows with the data, so it isn't broadcast; it is the side that is hashed, and texts aren't sorted.
    """
    keyed = docs.select("text", _row_key(docs).alias("row"))
    columns = ("grp", "node", "size", "digest", "twin")

    def texts(some: DataFrame) -> DataFrame:
        return keyed.join(some.drop("times").hint("shuffle_hash"), "row").select(*columns, "text")

    rows = texts(wanted.where("times = 1"))
    repeated = wanted.where("times > 1")
    if repeated.take(1):
        rows = rows.unionByName(texts(repeated).groupBy(*columns, F.md5("text").alias("_md5")).agg(F.first("text").alias("text")).drop("_md5"))
    return rows


def jaccard_classes(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every document.

    Documents link when 100 |A∩B| >= percent |A∪B| of their distinct word shingles; a text of fewer
    words is one shingle. Null, empty and wordless texts have no shingle and link with nothing.
    component_id is the least doc_id reachable by links. Every row is classed by its own text, also where
    rows repeat or share a doc_id; rows with a null one are linked like others but never name a class (null
    where a class has no other). Other columns are ignored; an empty table gives no rows.

    Sets that share a key and aren't ruled out by their sizes and marks form candidate components; inside
    each, sets are compared exactly until no pair is left whose outcome could change the components.
    """
    by_node = _row_classes(documents, words, percent)
    empty = F.col("n") == 0
    least = stored(by_node.where(~empty).groupBy("class").agg(F.min("doc_id").alias("least")), "least")
    out = by_node.join(least, "class", "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.when(empty, F.col("doc_id")).otherwise(F.col("least")).alias("component_id"))


def drop_near_copies(documents: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """The documents with one row of each class of near copies, own columns only.

    The row with the least doc_id stays; one with a null doc_id only where its whole class has none. Texts of
    one doc_id count by themselves, and of several rows that are equal in doc_id and text one stays,
    chosen by a hash of all columns. Null, empty and wordless texts are no copies; all their rows stay.
    """
    rows = _row_classes(documents, words, percent)
    by_row = rows.where("n > 0").groupBy("class", "row").agg(F.min("doc_id").alias("doc_id"), F.count("*").alias("times"))
    first = by_row.groupBy("class").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row", "times")).alias("r")).select("r.row", "r.times")
    first = stored(first, "first-rows")
    whole = first.where("times = 1").select("row").unionByName(rows.where("n = 0").select("row").distinct())
    out = documents.join(whole, _row_key(documents) == whole["row"], "left_semi")
    repeated = first.where("times > 1").select("row")
    if repeated.take(1):
        columns = F.struct(*(documents[f"`{c}`"] for c in documents.columns))
        some = documents.join(repeated, _row_key(documents) == repeated["row"], "left_semi")
        one = some.groupBy(_row_key(some).alias("_row")).agg(F.min_by(columns, F.xxhash64(F.to_json(columns))).alias("_kept"))
        out = out.unionByName(one.select("_kept.*"))
    return out
