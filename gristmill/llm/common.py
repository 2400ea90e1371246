"""Vectorised byte-level helpers shared by the text operators.

Everything here works on a *chunk*: the UTF-8 bytes of several whole texts laid end to end
(`data`, uint8) and their boundaries (`offsets`, one more than there are texts). Chunks hold about
`limit` bytes, so the working arrays stay small whatever the batch size; a text longer than the
limit is a chunk of its own, never cut.
"""

from __future__ import annotations

import ctypes
import hashlib
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

# ASCII white space as the contracts have it: space and \t \n \v \f \r.
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
IS_WORD = ~_SPACE
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_ODD = np.uint64(0x9E3779B97F4A7C15)
#: Keeps the first 0..8 bytes of a little-endian word.
_HEAD_MASK = np.array([(1 << (8 * k)) - 1 for k in range(9)], np.uint64)
#: Spans longer than this are hashed one by one.
LONG_SPAN = 64


def mix(h: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the whole word."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


def _step(h: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Hash states after one more word each: a one-to-one map of the state for a given word, and of the word for a given state."""
    h = (h ^ words) * _ODD
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    return h


def _words_at_every_byte(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from every place on (zeros behind the end) as one number each."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    return np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))


class SpanHash:
    """64-bit hashes of byte spans of a chunk, eight bytes a step over all spans that are as long.

    Spans of one length of at most 8 bytes never share a hash. Others of up to LONG_SPAN bytes go through a
    chain of mixing steps, longer ones through blake2b: no family of texts shares hashes by its structure.
    """

    def __init__(self, data: np.ndarray):
        self.data = data
        self.words = _words_at_every_byte(data)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        size = end - start
        h = _step(size.astype(np.uint64) * np.uint64(0xBF58476D1CE4E5B9), self.words[start] & _HEAD_MASK[np.minimum(size, 8)])
        more, done = np.flatnonzero((size > 8) & (size <= LONG_SPAN)), 8
        while len(more):
            h[more] = _step(h[more], self.words[start[more] + done] & _HEAD_MASK[np.minimum(size[more] - done, 8)])
            done += 8
            more = more[size[more] > done]
        raw = memoryview(self.data)
        for i in np.flatnonzero(size > LONG_SPAN).tolist():
            h[i] = int.from_bytes(hashlib.blake2b(raw[start[i] : end[i]], digest_size=8).digest(), "little")
        return h


def gram_hash(data: np.ndarray, k: int, block: int = 1 << 15) -> np.ndarray:
    """64-bit hashes of all runs of k bytes, worked out in blocks that fit a processor's cache."""
    n = len(data) - k + 1
    words = _words_at_every_byte(data)
    out = np.empty(max(n, 0), np.uint64)
    parts = [*range(0, k - 8, 8), k - 8] if k > 8 else [0]
    for first in range(0, n, block):
        end = min(first + block, n)
        h = np.full(end - first, k, np.uint64)
        for at in parts:
            h = _step(h, words[first + at : end + at] & _HEAD_MASK[min(k, 8)])
        out[first:end] = mix(h)
    return out


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and boundaries of a string column; nulls count as empty texts."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), offsets


def chunks(column: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets from 0) for runs of whole texts of about `limit` bytes."""
    data, offsets = text_buffers(column)
    row, rows = 0, len(offsets) - 1
    while row < rows:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, end, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


def word_spans(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and per text the index of its first word (one more at the end)."""
    is_word = IS_WORD[data]
    before = np.zeros(len(data), bool)
    before[1:] = is_word[:-1]
    inner = offsets[:-1][offsets[:-1] < len(data)]
    before[inner] = False
    after = np.zeros(len(data), bool)
    after[:-1] = is_word[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    after[last] = False
    start = np.flatnonzero(is_word & ~before)
    end = np.flatnonzero(is_word & ~after) + 1
    return start, end, np.searchsorted(start, offsets)


def owner(bounds: np.ndarray) -> np.ndarray:
    """Index of the text that each item belongs to, from per-text bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def ngram_hash(word_hash: np.ndarray, bounds: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of n words inside a text, and the index of each run's first word."""
    counts = np.diff(bounds)
    have = np.maximum(counts - n + 1, 0)
    first = np.repeat(bounds[:-1] - np.concatenate(([0], np.cumsum(have)[:-1])), have) + np.arange(int(have.sum()))
    h = np.zeros(len(first), np.uint64)
    for j in range(n):
        h = (h + word_hash[first + j]) * np.uint64(0xD6E8FEB86659FD93)
        h ^= h >> np.uint64(29)
    return mix(h), first


def release_memory() -> None:
    """Give freed pages back to the system: Python workers outlive their tasks and share the executor's memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # not glibc: nothing to give back
        pass


def shared_dir(spark, name: str) -> str:
    """A fresh folder under the cluster's shared checkpoint folder; on one machine without that setting, a temporary one."""
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="gristmill-")
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df, name: str):
    """The rows written to the shared folder and read again: cuts lineage and survives lost executors."""
    spark = df.sparkSession
    path = shared_dir(spark, name)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.__dict__["_stored_path"] = path
    return out


def discard(*frames) -> None:
    """Delete the folders of stored intermediates that nothing reads any more; other frames are left alone."""
    for df in frames:
        path = None if df is None else df.__dict__.get("_stored_path")
        if path:
            jvm = df.sparkSession._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(where, True)
