"""Suffix-array deduplication: bytes of strings that also start in an earlier document are removed.

Three Spark steps keep what is sorted small and co-located without losing a match:

1. Every `width`-byte string is assigned to the least-hashed k-gram inside it (its anchor). Equal
   strings have equal anchors, so only strings whose anchor occurs in two documents can repeat.
2. Around each such anchor a document contributes a window: the bytes of all strings that the anchor
   owns. Windows go to shards by anchor, each distinct one once, with the least document that uses it.
3. Strings whose anchors stand at nearly the same place have most of their bytes around the anchor in common. A window
   that shares none of these cores with another window of its shard has strings of its own only: its documents decide.
   Of the other windows each shard builds the suffix array by external induced sorting (`induced`). Neighbours with a
   common prefix of `width` are equal strings; the least document of each run decides. A shard gives, for
   each window, runs of strings with their least document.

Documents look up the runs of the windows they use in tasks of their own, so a passage that very many
documents share is sorted once and its uses are dealt over tasks.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SpanHash, chunks, discard, gram_hash, mix, release_memory, stored
from .induced import Disk, suffix_array
from .units import spread

#: Bytes of arrays that a shard keeps in memory; the rest of them lies in temporary files.
SHARD_MEMORY = 256 << 20
#: Bytes of texts for each shard, on average: a shard ten times as large takes twice the time a byte.
SHARD_TEXT = 16 << 20
#: Bytes of texts whose anchors are sought at a time: the working arrays fit a processor's cache.
ANCHOR_BYTES = 1 << 17
#: Uses of windows that one task looks up.
USES = 2_000_000


# --- anchors and windows -------------------------------------------------------------------------


def gram_size(width: int) -> int:
    return max(1, min(20, width // 2))


def _sliding_min(x: np.ndarray, n: int) -> np.ndarray:
    """Least of each n consecutive values."""
    have = 1
    while have < n:
        step = min(have, n - have)
        x = np.minimum(x[:-step], x[step:])
        have += step
    return x


def anchors(data: np.ndarray, offsets: np.ndarray, width: int):
    """Per owned run of string starts: text, key, first start, last start, place of the anchor (relative to the chunk).

    A string's anchor is the k-gram with the least hash inside it, the leftmost of equal ones.
    """
    k = gram_size(width)
    span = width - k + 1
    none = np.zeros(0, np.int64)
    if len(data) < width:
        return none, none.astype(np.uint64), none, none, none
    h = gram_hash(data, k)
    at = np.arange(len(h))
    packed = (h & np.uint64(0xFFFFFFFF80000000)) | at.astype(np.uint64)
    owner = (_sliding_min(packed, span) & np.uint64(0x7FFFFFFF)).astype(np.int64)
    # Strings that run over the end of their text don't count.
    starts = len(owner)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[:starts]
    inside = np.arange(starts) + width <= offsets[1:][text]
    change = np.ones(starts, bool)
    change[1:] = (owner[1:] != owner[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change & inside)
    ends = np.append(np.flatnonzero(change), starts)
    last = ends[np.searchsorted(ends, first, "right")] - 1
    return text[first], h[owner[first]] >> np.uint64(16), first, last, owner[first]


_ENTRY = np.dtype([("key", "<u8"), ("doc", "<i8")])


def _emit_keys(width: int, buckets: int):
    """Distinct (anchor key, document) pairs of each batch, packed by bucket: 6 bytes a key, ids compressed."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            parts = []
            for a, _, data, offsets in chunks(batch.column(1), ANCHOR_BYTES):
                text, key, *_ = anchors(data, offsets, width)
                entry = np.zeros(len(key), _ENTRY)
                entry["key"], entry["doc"] = key, ids[a + text]
                parts.append(entry)
            rows = np.concatenate(parts) if parts else np.zeros(0, _ENTRY)
            at = (rows["key"] % np.uint64(buckets)).astype(np.int64)
            order = np.argsort(at, kind="stable")
            rows, at = rows[order], at[order]
            cuts = np.searchsorted(at, np.arange(buckets + 1))
            out = {"bucket": [], "low": [], "high": [], "docs": []}
            for b in np.flatnonzero(np.diff(cuts)).tolist():
                part = rows[cuts[b] : cuts[b + 1]]
                out["bucket"].append(b)
                out["low"].append((part["key"] & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes())
                out["high"].append((part["key"] >> np.uint64(32)).astype("<u2").tobytes())
                step = np.diff(part["doc"], prepend=0)
                out["docs"].append(pa.compress(step.astype("<i8").tobytes(), "zstd", asbytes=True))
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("bucket", pa.int32()), ("low", pa.binary()), ("high", pa.binary()), ("docs", pa.binary())]))
            del rows, parts, out
            release_memory()

    return run


def _shared(table: pa.Table) -> pa.Table:
    """Of one bucket: (document, key) of keys that two documents or more have."""
    parts = []
    for low, high, docs in zip(*(table.column(c).to_pylist() for c in ("low", "high", "docs")), strict=True):
        part = np.zeros(len(high) // 2, _ENTRY)
        part["key"] = np.frombuffer(low, "<u4").astype(np.uint64) | (np.frombuffer(high, "<u2").astype(np.uint64) << np.uint64(32))
        part["doc"] = np.cumsum(np.frombuffer(pa.decompress(docs, decompressed_size=8 * len(part), codec="zstd", asbytes=True), "<i8"))
        parts.append(part)
    rows = np.concatenate(parts)
    rows = rows[np.argsort(rows["key"], kind="stable")]
    begin = np.flatnonzero(np.append(True, rows["key"][1:] != rows["key"][:-1]))
    apart = np.maximum.reduceat(rows["doc"], begin) != np.minimum.reduceat(rows["doc"], begin)
    rows = np.unique(rows[np.repeat(apart, np.diff(np.append(begin, len(rows))))])
    return pa.table({"doc_id": rows["doc"], "key": rows["key"].astype(np.int64)}, schema=pa.schema([("doc_id", pa.int64()), ("key", pa.int64())]))


_WINDOW = np.dtype([("id", "<u8"), ("low", "<i8"), ("high", "<i8"), ("size", "<u4"), ("anchor", "<u4")])
_USE = np.dtype([("id", "<u8"), ("doc", "<i8"), ("variant", "<u4"), ("at", "<u4")])
_RUN = np.dtype([("id", "<u8"), ("least", "<i8"), ("a", "<u4"), ("b", "<u4")])
_RANGE = np.dtype([("doc", "<i8"), ("variant", "<u4"), ("a", "<u4"), ("b", "<u4")])
_WINDOWS = pa.schema([("shard", pa.int32()), ("data", pa.binary()), ("about", pa.binary()), ("n_uses", pa.int64()), ("uses", pa.binary())])


def _squeezed(raw: np.ndarray) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(raw).tobytes(), "zstd", asbytes=True)


def _spread_out(raw: bytes) -> np.ndarray:
    return np.frombuffer(pa.decompress(raw[8:], int.from_bytes(raw[:8], "little"), "zstd", asbytes=True), np.uint8)


def _packed(rows: np.ndarray) -> bytes:
    """Records compressed byte place by byte place, so that the high bytes of neighbours lie together."""
    return _squeezed(rows.view(np.uint8).reshape(len(rows), rows.itemsize).T.ravel())


def _unpacked(raw: bytes, kind: np.dtype) -> np.ndarray:
    return np.ascontiguousarray(_spread_out(raw).reshape(kind.itemsize, -1).T).view(kind).ravel()


def _emit_windows(width: int, shards: int):
    """Windows around a document's shared anchors, one row per batch and shard: the distinct ones with their least and
    greatest document, and the uses, all compressed. A window is known by a 64-bit hash in its shard.
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            hot = batch.column(2)
            variants = batch.column(3).to_numpy(zero_copy_only=False)
            hot_ends, hot_keys = hot.offsets.to_numpy() - hot.offsets[0].as_py(), hot.flatten().to_numpy(zero_copy_only=False).astype(np.uint64)
            raws, sizes, places, uses, shard = [], [], [], [], []
            for a, b, data, offsets in chunks(batch.column(1), ANCHOR_BYTES):
                text, key, first, last, place = anchors(data, offsets, width)
                wanted = np.zeros(hot_ends[b] - hot_ends[a], _ENTRY)
                wanted["key"] = hot_keys[hot_ends[a] : hot_ends[b]]
                wanted["doc"] = np.repeat(np.arange(b - a), np.diff(hot_ends[a : b + 1]))
                own = np.zeros(len(key), _ENTRY)
                own["key"], own["doc"] = key, text
                keep = np.flatnonzero(np.isin(_fold(own), _fold(wanted)))
                start, end, text = first[keep], last[keep] + width, text[keep]
                some = np.zeros(len(keep), _USE)
                some["id"], some["doc"], some["at"] = SpanHash(data).of(start, end), ids[a + text], start - offsets[text]
                some["variant"] = variants[a + text]
                raws.append(data[spread(start, end - start)])
                sizes.append(end - start)
                places.append(place[keep] - start)
                uses.append(some)
                shard.append((key[keep] % np.uint64(shards)).astype(np.int64))
            raw, size, place, uses, shard = (
                np.concatenate(x) if x else np.zeros(0, kind) for x, kind in ((raws, np.uint8), (sizes, np.int64), (places, np.int64), (uses, _USE), (shard, np.int64))
            )
            order = np.lexsort((uses["id"], shard))
            start, size, place, uses, shard = (np.cumsum(size) - size)[order], size[order], place[order], uses[order], shard[order]
            new = np.flatnonzero(np.append(True, (shard[1:] != shard[:-1]) | (uses["id"][1:] != uses["id"][:-1]))[: len(uses)])
            about = np.zeros(len(new), _WINDOW)
            about["size"], about["anchor"] = size[new], place[new]
            if len(new):
                about["id"] = uses["id"][new]
                about["low"], about["high"] = np.minimum.reduceat(uses["doc"], new), np.maximum.reduceat(uses["doc"], new)
            out = {f.name: [] for f in _WINDOWS}
            for x in np.unique(shard).tolist():
                u, v = np.searchsorted(shard, [x, x + 1])
                p, q = np.searchsorted(new, [u, v])
                row = (x, _squeezed(raw[spread(start[new[p:q]], size[new[p:q]])]), _packed(about[p:q]), int(v - u), _packed(uses[u:v]))
                for values, value in zip(out.values(), row, strict=True):
                    values.append(value)
            yield pa.RecordBatch.from_pydict(out, schema=_WINDOWS)
            del out, raws, sizes, places, raw, uses, shard
            release_memory()

    return run


def _fold(rows: np.ndarray) -> np.ndarray:
    """One number per (48-bit key, row of a chunk); a rare clash only adds a window that repeats nothing."""
    return rows["key"] ^ (rows["doc"].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


# --- shards and look-ups ---------------------------------------------------------------------------


def _cores(raw: np.ndarray, start: np.ndarray, about: np.ndarray, width: int, ranges: int = 4) -> np.ndarray:
    """Per range of places that an anchor can have in a string: hashes of the bytes that all strings of the range have in
    common; a number of its own, the window's id, where the window has fewer, and so no string of that range.
    """
    k = gram_size(width)
    at, size = about["anchor"].astype(np.int64), about["size"].astype(np.int64)
    cuts = np.linspace(0, width - k + 1, ranges + 1).astype(np.int64)
    hasher, out = SpanHash(raw), np.tile(about["id"], (ranges, 1))
    for core, least, most in zip(out, cuts[:-1], cuts[1:] - 1, strict=True):
        behind = width - most  # from the anchor on
        some = (at >= least) & (at + behind <= size)
        core[some] = hasher.of(start[some] + at[some] - least, start[some] + at[some] + behind)
    return out


def _alone(cores: np.ndarray) -> np.ndarray:
    """Windows that share no core with another one."""
    out = np.ones(cores.shape[1], bool)
    for core in cores:
        _, back, count = np.unique(core, return_inverse=True, return_counts=True)
        out &= count[back] == 1
    return out


def _spool(batches: Iterator[pa.RecordBatch], width: int, memory: int):
    """(file of the bytes of distinct windows, their sizes, what is known about each, their cores) of a shard's rows."""
    file = tempfile.SpooledTemporaryFile(max_size=memory)
    known, sizes, cores, seen = np.zeros(0, np.uint64), [], [], []
    for batch in batches:
        raw = np.concatenate([_spread_out(x) for x in batch.column("data").to_pylist()])
        about = np.concatenate([_unpacked(x, _WINDOW) for x in batch.column("about").to_pylist()])
        size = about["size"].astype(np.int64)
        seen.append(about)
        _, fresh = np.unique(about["id"], return_index=True)
        fresh = fresh[~np.isin(about["id"][fresh], known)]
        start = np.cumsum(size) - size
        file.write(raw[spread(start[fresh], size[fresh])].tobytes())
        sizes.append((about["id"][fresh], size[fresh]))
        cores.append(_cores(raw, start[fresh], about[fresh], width))
        known = np.union1d(known, about["id"][fresh])
    seen = np.concatenate(seen)
    ids = np.concatenate([x for x, _ in sizes])
    order = np.argsort(ids)
    place = order[np.searchsorted(ids[order], seen["id"])]
    about = np.zeros(len(ids), _WINDOW)
    about["id"], about["low"], about["high"] = ids, np.iinfo(np.int64).max, np.iinfo(np.int64).min
    np.minimum.at(about["low"], place, seen["low"])
    np.maximum.at(about["high"], place, seen["high"])
    return file, np.concatenate([x for _, x in sizes]), about, np.concatenate(cores, 1)


def _chosen(file, size: np.ndarray, which: np.ndarray, memory: int, block: int = 1 << 13):
    """A file of the bytes of some of a file's windows."""
    out = tempfile.SpooledTemporaryFile(max_size=memory)
    file.seek(0)
    for a in range(0, len(size), block):
        some, keep = size[a : a + block], which[a : a + block]
        raw = np.frombuffer(file.read(int(some.sum())), np.uint8)
        out.write(raw[spread((np.cumsum(some) - some)[keep], some[keep])].tobytes())
    return out


def _own_runs(size: np.ndarray, about: np.ndarray, width: int) -> np.ndarray:
    """_RUN rows of windows whose strings no other window has, as `window_runs` gives them."""
    keep = (about["low"] < about["high"]) & (size >= width)
    out = np.zeros(int(keep.sum()), _RUN)
    out["id"], out["least"], out["b"] = about["id"][keep], about["low"][keep], size[keep] - width
    return out


def window_runs(file, size: np.ndarray, about: np.ndarray, width: int, memory: int, block: int = 1 << 13) -> Iterator[np.ndarray]:
    """_RUN rows of windows whose bytes lie in `file` one after the other: ranges of starts [a, b] in a window with the
    least document that has their string, where that isn't the greatest document that uses the window.
    """
    count = len(size)
    begin = np.cumsum(size + 1) - size - 1
    with Disk(memory) as disk:
        n = int(size.sum()) + count + 1
        text, of = disk.array(n, np.uint16), disk.array(n, np.int32)
        file.seek(0)
        for a in range(0, count, block):
            some = size[a : a + block]
            raw = np.frombuffer(file.read(int(some.sum())), np.uint8)
            part = np.ones(len(raw) + len(some), np.uint16)  # 1 ends a window, 0 the whole
            part[spread(np.cumsum(some + 1) - some - 1, some)] = raw.astype(np.uint16) + 2
            text[begin[a] : begin[a] + len(part)] = part
            of[begin[a] : begin[a] + len(part)] = np.repeat(np.arange(a, a + len(some)), some + 1)
        order, shared = suffix_array(text, 258, width, disk)
        least, of_run = disk.array(n, np.int64), disk.array(n, np.int64)
        of_run[:] = np.iinfo(np.int64).max
        # First the least document of each run of equal strings, then that of each place.
        for fill in (False, True):
            run = -1
            for a in range(0, n, 1 << 16):
                at, same = order[a : a + (1 << 16)].astype(np.int64), shared[a : a + (1 << 16)] >= width
                window = of[at]
                runs = run + np.cumsum(~same)
                run = int(runs[-1])
                if fill:
                    least[at] = of_run[runs]
                else:
                    whole = at - begin[window] + width <= size[window]
                    np.minimum.at(of_run, runs[whole], about["low"][window[whole]])
        for a in range(0, count, block):
            starts = np.maximum(size[a : a + block] - width + 1, 0)
            window = np.repeat(a + np.arange(len(starts)), starts)
            at = spread(begin[a : a + block], starts)
            value = least[at]
            new = np.append(True, (window[1:] != window[:-1]) | (value[1:] != value[:-1]))[: len(at)]
            first = np.flatnonzero(new)
            last = np.append(first[1:], len(at))[: len(first)] - 1
            keep = value[first] < about["high"][window[first]]
            first, last = first[keep], last[keep]
            out = np.zeros(len(first), _RUN)
            out["id"], out["least"] = about["id"][window[first]], value[first]
            out["a"], out["b"] = at[first] - begin[window[first]], at[last] - begin[window[first]]
            if len(out):
                yield out


def _shard(width: int, memory: int):
    def run(key: tuple[pa.Scalar, ...], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, size, about, cores = _spool(batches, width, memory)
        alone = _alone(cores)
        with file, _chosen(file, size, ~alone, memory) as rest:
            sorted_runs = () if alone.all() else window_runs(rest, size[~alone], about[~alone], width, memory)
            for runs in chain([_own_runs(size[alone], about[alone], width)], sorted_runs):
                if len(runs):
                    yield pa.RecordBatch.from_pydict({"shard": [key[0].as_py()], "data": [_packed(runs)]}, schema=pa.schema([("shard", pa.int32()), ("data", pa.binary())]))
        release_memory()

    return run


def _look_up(width: int, buckets: int):
    """Ranges to remove, packed by bucket of documents, from the runs of a shard and a part of its uses."""

    def run(table: pa.Table) -> pa.Table:
        is_use = table.column("is_use").to_pylist()
        raw = table.column("data").to_pylist()
        runs = np.concatenate([np.zeros(0, _RUN), *(_unpacked(x, _RUN) for x, u in zip(raw, is_use, strict=True) if not u)])
        runs = runs[np.argsort(runs["id"], kind="stable")]
        parts = []
        for x in (x for x, u in zip(raw, is_use, strict=True) if u):
            uses = _unpacked(x, _USE)
            low, high = (np.searchsorted(runs["id"], uses["id"], side) for side in ("left", "right"))
            use, of = np.repeat(np.arange(len(uses)), high - low), spread(low, high - low)
            keep = runs["least"][of] < uses["doc"][use]
            use, of = use[keep], of[keep]
            part = np.zeros(len(use), _RANGE)
            part["doc"], part["variant"] = uses["doc"][use], uses["variant"][use]
            part["a"], part["b"] = uses["at"][use] + runs["a"][of], uses["at"][use] + runs["b"][of] + width
            parts.append(part)
        ranges = np.concatenate(parts) if parts else np.zeros(0, _RANGE)
        at = (mix(ranges["doc"].astype(np.uint64)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(at, kind="stable")
        ranges, at = ranges[order], at[order]
        some = np.unique(at).tolist()
        packed = [_packed(ranges[slice(*np.searchsorted(at, [x, x + 1]))]) for x in some]
        del runs, parts, raw, ranges
        release_memory()
        return pa.table({"bucket": some, "ranges": packed}, schema=pa.schema([("bucket", pa.int32()), ("ranges", pa.binary())]))

    return run


def _spans(table: pa.Table) -> pa.Table:
    """Of one bucket of documents: overlapping or touching ranges joined, one row a text."""
    rows = np.concatenate([_unpacked(x, _RANGE) for x in table.column("ranges").to_pylist()])
    rows = rows[np.lexsort((rows["a"], rows["variant"], rows["doc"]))]
    new_doc = np.append(True, (rows["doc"][1:] != rows["doc"][:-1]) | (rows["variant"][1:] != rows["variant"][:-1]))[: len(rows)]
    doc = np.cumsum(new_doc) - 1
    a, b = rows["a"].astype(np.int64), rows["b"].astype(np.int64)
    # Ends so far within a document: documents are shifted far apart so one running maximum does.
    far = doc * (int(b.max(initial=0)) + 2)
    reach = np.maximum.accumulate(b + far)
    new = np.append(True, (a + far)[1:] > reach[:-1])[: len(rows)]
    begin = np.flatnonzero(new)
    stop = np.append(begin[1:], len(rows))[: len(begin)] - 1
    ends = np.concatenate(([0], np.cumsum(np.bincount(doc[begin], minlength=int(new_doc.sum())))))
    spans = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays([pa.array(a[begin]), pa.array((reach - far)[stop])], ["a", "b"]))
    out = pa.table({"doc_id": pa.array(rows["doc"][new_doc]), "variant": pa.array(rows["variant"][new_doc].astype(np.int32)), "spans": spans})
    release_memory()
    return out


SPANS = "array<struct<a: long, b: long>>"


def _digests(documents: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc_id, d, n, variant) of every row with an id, stored, and (doc_id, d, variant) of ids with several texts if there are any.

    d is the text's md5; the texts of one id are variants 0, 1, ... in order of d.
    """
    texts = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    digests = stored(texts.select("doc_id", F.md5("text").alias("d"), F.octet_length("text").alias("n")), "digests")
    several = digests.groupBy("doc_id").agg(F.min("d").alias("a"), F.max("d").alias("b")).where("a <> b").select("doc_id")
    if not several.take(1):
        return digests, None
    order = Window.partitionBy("doc_id").orderBy("d")
    variants = stored(digests.join(several, "doc_id", "left_semi").select("doc_id", "d").distinct().withColumn("variant", F.row_number().over(order) - 1), "variants")
    return digests, variants


def _numbered(rows: DataFrame, variants: DataFrame | None, digest: Column) -> DataFrame:
    """The rows with the number of their text among those of their id (`variant`); no join where every id has one text."""
    if variants is None:
        return rows.withColumn("variant", F.lit(0))
    joined = rows.withColumn("_d", digest).join(variants.withColumnRenamed("d", "_d").hint("shuffle_hash"), ["doc_id", "_d"], "left")
    return joined.select(*(rows[f"`{c}`"] for c in rows.columns), F.coalesce("variant", F.lit(0)).alias("variant"))


def repeated_spans(documents: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, d, spans), stored: maximal byte ranges [a, b) covered by repeated strings, of texts that have any.

    A `width`-byte string of the text (UTF-8, null: empty) is repeated if it also starts in a document
    with a smaller doc_id; matches never cross texts and are judged on the whole input. Equal texts
    are sorted once, as their least doc_id; the others repeat it from end to end. Texts that share a doc_id each have
    spans of their own and don't repeat each other; d, null where an id has one text, is the md5 that tells them apart.
    Rows with a null doc_id repeat nothing and are not repeated.

    Lists of ids and spans grow with the data, so none is broadcast; texts are dealt by doc_id once for both
    the search for anchors and the windows.
    """
    spark = documents.sparkSession
    if width < 2:
        raise ValueError("width must be 2 at least")
    digests, variants = _digests(documents)
    docs = documents.where(F.col("doc_id").isNotNull()).select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    docs = _numbered(docs, variants, F.md5("text"))
    least = digests.groupBy("d").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("last")).where("least <> last").select("d", "least")
    least = stored(least, "least")
    copies = _numbered(digests.join(least, "d").where("doc_id <> least").select("doc_id", "d", "n"), variants, F.col("d"))
    copies = stored(copies.select("doc_id", "variant", "n").distinct(), "copies")
    discard(least)
    unique = docs.where(F.octet_length("text") >= width).join(copies.select("doc_id", "variant").hint("shuffle_hash"), ["doc_id", "variant"], "left_anti")
    # Shards follow the texts, however many partitions the session has.
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -((digests.agg(F.sum("n")).first()[0] or 0) // -SHARD_TEXT))
    keys = unique.select("doc_id", "text").mapInArrow(_emit_keys(width, shards), "bucket int, low binary, high binary, docs binary")
    shared = keys.groupBy("bucket").applyInArrow(_shared, "doc_id long, key long")
    hot = shared.groupBy("doc_id").agg(F.collect_list("key").alias("keys"))
    emitted = unique.join(hot.hint("shuffle_hash"), "doc_id").select("doc_id", "text", "keys", "variant").mapInArrow(_emit_windows(width, shards), "shard int, data binary, about binary, n_uses long, uses binary")
    emitted = stored(emitted, "windows")
    uses = emitted.select("shard", "n_uses", F.col("uses").alias("data"))
    runs = emitted.select("shard", "data", "about").groupBy("shard").applyInArrow(_shard(width, SHARD_MEMORY), "shard int, data binary")
    runs = stored(runs, "runs")
    parts = uses.groupBy("shard").agg(F.ceil(F.sum("n_uses") / USES).cast("int").alias("parts"))
    dealt = uses.join(F.broadcast(parts), "shard").select("shard", F.pmod(F.xxhash64("data"), F.col("parts")).cast("int").alias("part"), F.lit(True).alias("is_use"), "data")
    copied = runs.join(F.broadcast(parts), "shard").select("shard", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), F.lit(False).alias("is_use"), "data")
    ranges = dealt.unionByName(copied).groupBy("shard", "part").applyInArrow(_look_up(width, shards), "bucket int, ranges binary")
    own = ranges.groupBy("bucket").applyInArrow(_spans, f"doc_id long, variant int, spans {SPANS}")
    whole = F.array(F.struct(F.lit(0).cast("long").alias("a"), F.col("n").cast("long").alias("b")))
    found = own.unionByName(copies.where(F.col("n") >= width).select("doc_id", "variant", whole.alias("spans")))
    if variants is None:
        out = stored(found.select("doc_id", F.lit(None).cast("string").alias("d"), "spans"), "spans")
    else:
        out = stored(found.join(variants.hint("shuffle_hash"), ["doc_id", "variant"], "left").select("doc_id", "d", "spans"), "spans")
    out.__dict__["_several"] = variants is not None
    discard(copies, emitted, runs, digests, variants)
    return out


def _own_spans(documents: DataFrame, spans: DataFrame) -> Column:
    """Whether a row of spans belongs to a document's text; the md5 matters only where an id has several texts."""
    same = documents["doc_id"] == spans["doc_id"]
    return same & (F.coalesce(spans["d"], F.lit("")) == F.when(spans["d"].isNull(), "").otherwise(F.md5(F.coalesce(documents["text"], F.lit(""))))) if spans.__dict__["_several"] else same


def _without(text: Column, spans: Column, whole_characters: bool) -> Column:
    """Bytes of a text outside the spans; null spans give null."""

    @F.arrow_udf("binary")
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for t, r in zip(texts.to_pylist(), ranges.to_pylist(), strict=True):
            if r is None:
                out.append(None)
                continue
            raw, at, kept = (t or "").encode(), 0, []
            for s in r:
                a, b = s["a"], s["b"]
                if whole_characters:
                    while a < b and raw[a] & 0xC0 == 0x80:
                        a += 1
                    while b > a and b < len(raw) and raw[b] & 0xC0 == 0x80:
                        b -= 1
                kept.append(raw[at:a])
                at = b
            out.append(b"".join([*kept, raw[at:]]))
        return pa.array(out, pa.binary())

    return cut(F.when(spans.isNotNull(), text), spans)


def remove_repeats(documents: DataFrame, width: int = 50) -> DataFrame:
    """(doc_id, n_bytes, spans, kept) for every document: spans removed and the bytes left (binary).

    Documents without repeats have null spans. An empty table gives no rows.
    """
    docs = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = repeated_spans(docs, width)
    joined = docs.join(spans.hint("shuffle_hash"), _own_spans(docs, spans), "left").select(docs["doc_id"], docs["text"], spans["spans"])
    kept = F.coalesce(_without(F.col("text"), F.col("spans"), False), F.encode("text", "UTF-8"))
    return joined.select("doc_id", F.octet_length("text").cast("long").alias("n_bytes"), "spans", kept.alias("kept"))


def cut_repeats(documents: DataFrame, width: int = 50) -> DataFrame:
    """The documents, own columns only, with repeated passages cut from their texts at whole characters.

    A column n_chars, where there is one, follows the texts that are cut.
    """
    spans = repeated_spans(documents, width)
    text = F.coalesce(F.decode(_without(documents["text"], spans["spans"], True), "UTF-8"), documents["text"])
    joined = documents.join(spans.hint("shuffle_hash"), _own_spans(documents, spans), "left")
    new = {"text": text, "n_chars": F.when(spans["spans"].isNull(), documents["n_chars"]).otherwise(F.length(text).cast("long"))} if "n_chars" in documents.columns else {"text": text}
    return joined.select(*(new[c].alias(c) if c in new else documents[f"`{c}`"] for c in documents.columns))
