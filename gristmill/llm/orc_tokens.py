"""Token ids in ORC files: integer run-length encoding, row indexes, Bloom filters on document ids.

Files hold rows (doc_id, n_tokens, ids) in ascending doc_id order: range-partitioned, so each file
covers an id range of its own, and sorted inside, so stripe and row-group statistics prune lookups
and stripes can be read in parallel.
"""

from __future__ import annotations

import json
import os
import zlib
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .bpe import byte_characters
from .common import release_memory
from .units import UnitTable, encode_texts

ORC_OPTIONS = {
    "compression": "zstd",
    "orc.stripe.size": str(64 << 20),
    "orc.row.index.stride": "10000",
    "orc.create.index": "true",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}
#: Fixed value: the pre-token pattern for which the array rules of `units.cut` hold.
_KNOWN_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


@lru_cache(maxsize=2)
def _library(path: str):
    """The library's tokenizer, its control strings and, where the array rules hold, a unit table."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    special = tuple(t["content"] for t in spec.get("added_tokens", []))
    steps = [x.get("type") for x in (spec.get("normalizer") or {}).get("normalizers", [])]
    splits = [x.get("pattern", {}).get("Regex") for x in (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])]
    shown = {chr(b): c for c, b in byte_characters().items()}

    def encode_text(text: str) -> list[int]:
        return tokenizer.encode(text, add_special_tokens=False).ids

    def encode_unit(text: str) -> list[int]:
        # The model step alone does for plain ASCII; anything else goes through the whole library.
        if text.isascii() and "'" not in text and "<" not in text:
            return [t.id for t in tokenizer.model.tokenize("".join([shown[c] for c in text]))]
        return encode_text(text)

    fits = steps == ["NFC", "Replace", "Lowercase"] and splits[:1] == [_KNOWN_SPLIT] and spec["model"]["type"] == "BPE"
    return encode_text, special, UnitTable(encode_unit) if fits else None


def library_ids(column: pa.Array, path: str):
    """(ids, ids per text) for runs of texts, equal to the tokenizers library's encode of each text."""
    encode_text, special, table = _library(path)
    if table is None:
        each = [np.array(encode_text(x or ""), np.int32) for x in column.to_pylist()]
        yield np.concatenate(each) if each else np.zeros(0, np.int32), np.array([len(x) for x in each], np.int64)
    else:
        yield from encode_texts(column, table, encode_text, special, keep_space=False, lower=True)
    release_memory()


def token_ids(text: Column | str, path: str, end_id: int | None = None) -> Column:
    """Ids of a whole text (array of int) as the tokenizers library gives them, `end_id` appended.

    A null text counts as empty: only the end id is left.
    """

    @F.arrow_udf("array<int>")
    def encode(column: pa.Array) -> pa.Array:
        parts, counts = [], []
        for ids, n in library_ids(column, path):
            if end_id is not None:
                ids, n = np.insert(ids, np.cumsum(n), end_id), n + 1
            parts.append(ids)
            counts.append(n)
        offsets = np.zeros(len(column) + 1, np.int32)
        if counts:
            np.cumsum(np.concatenate(counts), out=offsets[1:])
        values = np.concatenate(parts).astype(np.int32) if parts else np.zeros(0, np.int32)
        return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))

    return encode(F.col(text) if isinstance(text, str) else text)


def write_token_files(documents: DataFrame, out: str, path: str, end_id: int | None = 1, **options: str) -> None:
    """Encode every text and write the files to `out`, ids of documents ascending over the files.

    Rows with one doc_id lie side by side, ordered by text; a null doc_id comes first; null texts
    are empty. `row` numbers the rows in the order in which they stand, with gaps between files. Other columns are not written. No rows give an empty folder of files. `options` change ORC_OPTIONS.
    """
    rows = documents.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    tokens = ordered.select("doc_id", token_ids("text", path, end_id).alias("ids"))
    tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", F.monotonically_increasing_id().alias("row")).write.options(**ORC_OPTIONS | options).orc(out)


def read_token_files(spark: SparkSession, out: str) -> DataFrame:
    """(doc_id, n_tokens, ids, row); filters on doc_id skip stripes and row groups by their metadata."""
    return spark.read.schema("doc_id long, n_tokens long, ids array<int>, row long").orc(out)


def token_starts(spark: SparkSession, out: str) -> DataFrame:
    """(file, before, doc_id, n_tokens, ids, row): `before` counts the ids of all files before.

    File totals need one narrow column; only one row per file is summed over all files, and rows are
    numbered inside their own file, whose size the range partitioning bounds.
    """
    rows = read_token_files(spark, out).withColumn("file", F.col("_metadata.file_name"))
    sums = rows.groupBy("file").agg(F.min("row").alias("first"), F.sum("n_tokens").alias("total"))
    order = Window.orderBy("first").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("file", F.coalesce(F.sum("total").over(order), F.lit(0)).alias("before"))
    return rows.join(F.broadcast(offsets), "file")


def ids_crc32(ids: Column | str) -> Column:
    """Unsigned crc32 of ids as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("long")
    def crc(column: pa.Array) -> pa.Array:
        values = memoryview(np.ascontiguousarray(column.values.to_numpy(zero_copy_only=False)).astype("<u4", copy=False)).cast("B")
        ends = column.offsets.to_numpy() * 4
        return pa.array([zlib.crc32(values[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())

    return crc(F.col(ids) if isinstance(ids, str) else ids)


def digest(spark: SparkSession, out: str) -> DataFrame:
    """Per document: doc_id, start, n_tokens, ids_crc32, all read from the files; rows of one doc_id are counted as they stand."""
    rows = token_starts(spark, out).select("file", "before", "row", "doc_id", F.size("ids").cast("long").alias("n_tokens"), ids_crc32("ids").alias("ids_crc32"))
    order = Window.partitionBy("file").orderBy("row")
    inside = F.coalesce(F.sum("n_tokens").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return rows.select("doc_id", (F.col("before") + inside).alias("start"), "n_tokens", "ids_crc32")
