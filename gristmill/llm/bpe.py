"""Byte-level BPE: exact encoding with a backtracking encoder, decoding with an offset table.

The encoder takes at each place the longest token that an Aho-Corasick automaton finds there and
keeps it if merging could have left the pair (last token, new token) side by side; otherwise it
tries the next shorter prefix token, and when none is left it takes the last token back. A place that
has failed once is never tried again, so the time is linear in the text. Whether a pair can stand
is looked up in a compatibility table, filled as pairs are met by undoing merges along the border.
"""

from __future__ import annotations

import json
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory
from .units import UnitTable, encode_texts

#: Fixed value: the published pre-token pattern of this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


def byte_characters() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary file, and its byte."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class BytePairCoder:
    """Encoder and decoder of one vocabulary file (`vocab` and `merges` of a byte-level BPE)."""

    def __init__(self, path: str, most_pairs: int = 1_000_000):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        of_char = byte_characters()
        vocab = spec["model"]["vocab"]
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.bytes = {i: bytes(of_char[c] for c in token) for token, i in vocab.items() if token not in self.special}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        # Ids need not follow the merge order, so everything below compares ranks: single bytes first.
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["model"]["merges"]]
        singles = [vocab[c] for c in of_char if c in vocab]
        self.rank = {i: k for k, i in enumerate(singles)}
        self.parts: dict[int, tuple[int, int]] = {}
        self.merged: dict[tuple[int, int], int] = {}
        for left, right in merges:
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            self.merged[pair] = made
            if made not in self.rank:
                self.rank[made] = len(self.rank)
                self.parts[made] = pair
        by_text = {self.bytes[i].decode("latin-1"): i for i in self.rank}
        self.shorter = {}
        for text, i in by_text.items():
            self.shorter[i] = next((by_text[text[:k]] for k in range(len(text) - 1, 0, -1) if text[:k] in by_text), None)
        self.width = {i: len(self.bytes[i]) for i in self.rank}
        self.automaton = ahocorasick.Automaton()
        for text, i in by_text.items():
            self.automaton.add_word(text, i)
        self.automaton.make_automaton()
        self.compatible: dict[tuple[int, int], bool] = {}
        self.most_pairs = most_pairs
        self.pattern = regex.compile(PATTERN)
        size = max(self.bytes) + 1
        pieces = [self.bytes.get(i, b"") for i in range(size)]
        self.piece_length = np.array([len(p) for p in pieces], np.int64)
        self.piece_at = np.concatenate(([0], np.cumsum(self.piece_length)[:-1]))
        self.piece_bytes = np.frombuffer(b"".join(pieces), np.uint8)

    def can_stand(self, left: int, right: int) -> bool:
        """Whether merging leaves these two tokens side by side, looked up or worked out once."""
        known = self.compatible.get((left, right))
        if known is None:
            if len(self.compatible) >= self.most_pairs:
                self.compatible.clear()
            known = self.compatible[left, right] = self._border_holds(left, right)
        return known

    def _border_holds(self, left: int, right: int) -> bool:
        """Undo the latest merge on either side of the border, step by step.

        At each step the border pair exists at the same time; had it a merge that comes before the
        merges undone so far, BPE would have joined across the border.
        """
        rank, parts = self.rank, self.parts
        # Merges across the border win when they come before `bound`; ties go to the leftmost.
        bound = len(rank) + 1
        while True:
            across = self.merged.get((left, right))
            if across is not None and rank[across] < bound:
                return False
            undo_left = left in parts and (right not in parts or rank[left] > rank[right])
            if undo_left:
                bound, left = rank[left], parts[left][1]
            elif right in parts:
                # The left neighbour pair is met first in a scan, so an equal rank also wins.
                bound, right = rank[right] + 1, parts[right][0]
            else:
                return True

    def encode_piece(self, raw: bytes) -> list[int]:
        """Exact BPE of one pre-token."""
        text = raw.decode("latin-1")
        n = len(text)
        longest: list[int | None] = [None] * (n + 1)
        for end, i in self.automaton.iter(text):
            longest[end - self.width[i] + 1] = i  # matches come by end, so the longest stays
        if n and self.width.get(longest[0]) == n:
            return [longest[0]]
        failed = bytearray(n + 1)
        out: list[int] = []
        at, token = 0, longest[0]
        while token is not None:
            last = out[-1] if out else None
            while True:
                end = at + self.width[token]
                if not failed[end] and (last is None or self.can_stand(last, token)):
                    out.append(token)
                    at, token = end, longest[end]
                    break
                token = self.shorter[token]
                if token is None:
                    failed[at] = 1
                    token = out.pop()
                    at -= self.width[token]
                    break
        return out

    def encode_unit(self, text: str) -> list[int]:
        if "'" not in text:
            return self.encode_piece(text.encode())
        return [i for piece in self.pattern.findall(text) for i in self.encode_piece(piece.encode())]

    def encode_text(self, text: str) -> list[int]:
        """Ids of a whole text; special strings inside it become their own ids, as the library has it."""
        out: list[int] = []
        parts = regex.split("(" + "|".join(map(regex.escape, self.special)) + ")", text) if self.special else [text]
        for part in parts:
            if part in self.special:
                out.append(self.special[part])
            else:
                for piece in self.pattern.findall(part):
                    out += self.encode_piece(piece.encode())
        return out

    def decode_ids(self, ids: np.ndarray) -> bytes:
        """Bytes of the tokens one after the other: one gather from the offset table."""
        length = self.piece_length[ids]
        total = np.cumsum(length)
        if not len(total):
            return b""
        spread = np.repeat(self.piece_at[ids] - (total - length), length)
        return self.piece_bytes[spread + np.arange(total[-1])].tobytes()


@lru_cache(maxsize=2)
def coder(path: str) -> tuple[BytePairCoder, UnitTable]:
    """One coder and one table of known pre-tokens per Python worker."""
    made = BytePairCoder(path)
    return made, UnitTable(made.encode_unit)


def encoded(column: pa.Array, path: str):
    made, table = coder(path)
    yield from encode_texts(column, table, made.encode_text, tuple(made.special), keep_space=True, lower=False)
    release_memory()


def bpe_encode(text: Column | str, path: str) -> Column:
    """Ids of a text as little-endian unsigned 32-bit integers (binary).

    A null text counts as empty and gives an empty binary. Texts of any length are encoded whole.
    """

    @F.arrow_udf("binary")
    def encode(column: pa.Array) -> pa.Array:
        parts, counts = [], []
        for ids, per_text in encoded(column, path):
            parts.append(ids.astype("<u4").tobytes())
            counts.append(per_text)
        sizes = np.concatenate(counts) * 4 if counts else np.zeros(0, np.int64)
        offsets = np.zeros(len(column) + 1, np.int32)
        np.cumsum(sizes, out=offsets[1:])
        return pa.Array.from_buffers(pa.binary(), len(column), [None, pa.py_buffer(offsets), pa.py_buffer(b"".join(parts))])

    return encode(F.col(text) if isinstance(text, str) else text)


def bpe_decode(ids: Column | str, path: str) -> Column:
    """The text of ids packed by `bpe_encode`; bytes that aren't UTF-8 become U+FFFD. Null gives the empty text."""

    @F.arrow_udf("string")
    def decode(column: pa.Array) -> pa.Array:
        made, _ = coder(path)
        return pa.array([made.decode_ids(np.frombuffer(x or b"", "<u4").astype(np.int64)).decode("utf-8", "replace") for x in column.to_pylist()], pa.string())

    return decode(F.col(ids) if isinstance(ids, str) else ids)


def token_count(text: Column | str, path: str) -> Column:
    """Number of ids of a whole text (long); a null text has none."""

    @F.arrow_udf("long")
    def count(column: pa.Array) -> pa.Array:
        counts = [per_text for _, per_text in encoded(column, path)]
        return pa.array(np.concatenate(counts) if counts else np.zeros(0, np.int64), pa.int64())

    return count(F.col(text) if isinstance(text, str) else text)


def unpack_ids(ids: Column | str) -> Column:
    """Packed ids as an array of long."""

    @F.arrow_udf("array<long>")
    def unpack(column: pa.Array) -> pa.Array:
        return pa.array([None if x is None else np.frombuffer(x, "<u4").astype(np.int64) for x in column.to_pylist()], pa.list_(pa.int64()))

    return unpack(F.col(ids) if isinstance(ids, str) else ids)


def encode_documents(documents: DataFrame, path: str) -> DataFrame:
    """(doc_id, n_tokens, ids) of every document: ids as array<int>, in the order of the text.

    A null or empty text has no ids; other columns are dropped.
    """

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        parts = list(encoded(column, path))
        counts = np.concatenate([n for _, n in parts]) if parts else np.zeros(0, np.int64)
        ids = np.concatenate([i for i, _ in parts]).astype(np.int32) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(counts))), pa.int32()), pa.array(ids, pa.int32()))

    rows = documents.select("doc_id", encode("text").alias("ids"))
    return rows.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids")
