"""Chunked, resumable export to JSON lines, JSON arrays, CSV and Parquet."""

from __future__ import annotations

import hashlib
import json
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.utils import AnalysisException

from ..failures import FAILURES
from .state import delete_folder, shared_folder

CHUNK_ROWS = 5000
#: Chunk of the rows without a key, below all others.
NO_KEY = -(2**63)
#: CSV files keep null (nothing) apart from the empty text (two quotes), blanks at both ends, and line breaks inside quotes.
CSV_OPTIONS = {"header": "true", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
#: What the CSV reader takes for a field that isn't there; no text of a table is this.
_NOTHING = "\x00nothing\x00"


def id_chunks(df: DataFrame, key: str, size: int = CHUNK_ROWS, origin=None) -> DataFrame:
    """`_chunk` by key range: floor((key - origin) / size); the origin is the least key unless given. No shuffle of rows.

    Rows with a null key are the chunk NO_KEY.
    """
    low = df.agg(F.min(key)).scalar() if origin is None else F.lit(origin)
    return df.withColumn("_chunk", F.coalesce(F.floor((F.col(key) - low) / size).cast("long"), F.lit(NO_KEY)))


def offset_chunks(df: DataFrame, order_by: list[str], size: int = CHUNK_ROWS) -> DataFrame:
    """`_chunk` by place in the order: rows are numbered inside range partitions, whose sizes are then added up.

    The range partitions are written first, one file each: worked out twice, their bounds could differ.
    Only one row per file is summed over all; no task sees all rows. Rows that tie have no order between them.
    """
    spark, path = df.sparkSession, shared_folder(df.sparkSession, "ranges")
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.parquet(path)
    ranged = spark.read.schema(df.schema).parquet(path).withColumn("_file", F.col("_metadata.file_name"))
    numbered = ranged.withColumn("_row", F.row_number().over(Window.partitionBy("_file").orderBy(*order_by)))
    sizes = ranged.groupBy("_file").agg(F.count("*").alias("n"), F.min(F.struct(*(F.col(c) for c in order_by))).alias("first"))
    before = Window.orderBy("first", "_file").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select("_file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_before"))
    placed = numbered.join(F.broadcast(sizes), "_file")
    return placed.withColumn("_chunk", F.floor((F.col("_before") + F.col("_row") - 1) / size).cast("long")).select(*df.columns, "_chunk")


def chunk_manifest(chunked: DataFrame) -> DataFrame:
    """(chunk, rows, checksum) of a chunked table; the checksum doesn't depend on the order of rows."""
    data = [F.col(f"`{f.name}`") for f in chunked.schema if f.name != "_chunk" and not isinstance(f.dataType, T.MapType)]
    return chunked.groupBy(F.col("_chunk").alias("chunk")).agg(F.count("*").alias("rows"), F.bit_xor(F.xxhash64(*data)).alias("checksum"))


def pending(chunked: DataFrame, done: DataFrame) -> DataFrame:
    """Rows of chunks that the manifest doesn't have yet."""
    return chunked.join(done.select(F.col("chunk").alias("_chunk")).distinct(), "_chunk", "left_anti")


def json_arrays(chunked: DataFrame, order_by: list[str] | None = None) -> DataFrame:
    """One JSON array per chunk, rows in the order given, else of their fields; a chunk's rows are bounded by its size."""
    row = F.struct(*(F.col(f"`{c}`") for c in chunked.columns if c != "_chunk"))
    rank = F.struct(F.struct(*(F.col(f"`{c}`") for c in order_by or [])).alias("o"), row.alias("r")) if order_by else F.struct(row.alias("r"))
    return chunked.groupBy("_chunk").agg(F.to_json(F.sort_array(F.collect_list(rank))["r"], {"ignoreNullFields": "false"}).alias("value"))


_NESTED = (T.ArrayType, T.MapType, T.StructType)


def _flat(df: DataFrame) -> DataFrame:
    """Nested columns as JSON text."""
    return df.select(*(F.to_json(F.col(f"`{f.name}`")).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`") for f in df.schema))


def _flat_schema(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, T.StringType() if isinstance(f.dataType, _NESTED) else f.dataType) for f in schema])


def _unflat(df: DataFrame, schema: T.StructType) -> DataFrame:
    return df.select(*(F.from_json(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if isinstance(f.dataType, _NESTED) else F.col(f"`{f.name}`") for f in schema))


def write_chunks(chunked: DataFrame, path: str, kind: str, gzip: bool = False, order_by: list[str] | None = None) -> None:
    """Files of each chunk under `_chunk=<n>`, rows in order; chunks are written in parallel, and only those given are replaced."""
    # Rebalanced by chunk: a chunk far larger than the others (rows without a key) is split into several files.
    parts = chunked.hint("rebalance", "_chunk").sortWithinPartitions("_chunk", *(order_by or []))
    if kind == "json":
        writer, fmt = json_arrays(chunked, order_by).write, "text"
    else:
        writer, fmt = (_flat(parts) if kind == "csv" else parts).write, {"jsonl": "json", "csv": "csv", "parquet": "parquet"}[kind]
    if kind == "csv":
        writer = writer.options(**CSV_OPTIONS, nullValue="", emptyValue='""')
    if kind == "jsonl":
        writer = writer.option("ignoreNullFields", "false")
    if gzip and kind in ("jsonl", "json"):
        writer = writer.option("compression", "gzip")
    writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_chunk").format(fmt).save(path)


def read_export(spark: SparkSession, path: str, kind: str, schema: T.StructType) -> DataFrame:
    """The exported rows, without the chunk column."""
    if kind == "json":
        rows = spark.read.option("wholetext", True).text(path).select(F.explode(F.from_json("value", T.ArrayType(schema))).alias("r"))
        return rows.select("r.*")
    if kind == "csv":
        return _unflat(spark.read.options(**CSV_OPTIONS, nullValue=_NOTHING, emptyValue="", multiLine="true").schema(_flat_schema(schema)).csv(path), schema)
    reader = spark.read.schema(schema)
    return {"jsonl": reader.json, "parquet": reader.parquet}[kind](path).select(*schema.names)


MANIFEST = "chunk long, rows long, checksum long, origin string, seconds double, at double"


def manifest(spark: SparkSession, path: str) -> DataFrame:
    """Latest entry of each chunk that is there."""
    try:
        rows = spark.read.schema(MANIFEST).parquet(f"{path}-manifest")
    except AnalysisException:
        return spark.createDataFrame([], MANIFEST)
    return rows.groupBy("chunk").agg(F.max_by(F.struct("rows", "checksum", "origin", "seconds", "at"), "at").alias("m")).select("chunk", "m.*").where("rows > 0")


def export(df: DataFrame, path: str, kind: str = "parquet", key: str | None = None, order_by: list[str] | None = None, size: int = CHUNK_ROWS, where: str | None = None, after=None, gzip: bool = False) -> DataFrame:
    """Write the chunks that are new or differ from the manifest, and return export statistics.

    Chunks are key ranges if `key` is given, else places in `order_by`; rows of a chunk are in the order
    of `order_by`, else of the key. Key ranges count from the least key of the first run, which the manifest
    keeps: a smaller key that comes later gets a chunk below 0. A chunk whose row count or checksum has changed
    is written again; one that the source no longer has is deleted, unless `after` says that the run continues behind a
    key. Removing the manifest folder starts over.
    """
    spark, rows = df.sparkSession, df if where is None else df.where(where)
    if after is not None:
        rows = rows.where(F.col(key or order_by[0]) > F.lit(after))
    done, origin = manifest(spark, path), None
    if key:
        first = done.where("origin IS NOT NULL").select("origin").first()
        origin = first.origin if first else rows.agg(F.min(key).cast("string")).first()[0]
        chunked = id_chunks(rows, key, size, F.lit(origin).cast(rows.schema[key].dataType))
    else:
        chunked = offset_chunks(rows, order_by or rows.columns[:1], size)
    # Counted before the files are written: what the source gains meanwhile differs from the manifest in the next run.
    known = done.select("chunk", F.col("rows").alias("_r"), F.col("checksum").alias("_c"))
    same = F.col("rows").eqNullSafe(F.col("_r")) & F.col("checksum").eqNullSafe(F.col("_c"))
    counted = shared_folder(spark, "chunks")
    found = chunk_manifest(chunked).join(known, "chunk", "left" if after is not None else "full_outer").where(~same)
    found.select("chunk", F.coalesce("rows", F.lit(0).cast("long")).alias("rows"), "checksum").write.parquet(counted)
    changed = spark.read.parquet(counted)
    for gone in changed.where("rows = 0").select("chunk").toLocalIterator():
        delete_folder(spark, f"{path}/_chunk={gone.chunk}")
    began = time.time()
    left = chunked.join(changed.select(F.col("chunk").alias("_chunk")), "_chunk", "left_semi").select(*chunked.columns)
    write_chunks(left, path, kind, gzip, order_by or ([key] if key else None))
    entry = changed.withColumns({"origin": F.lit(origin).cast("string"), "seconds": F.lit(time.time() - began), "at": F.lit(time.time())})
    entry.select(*spark.createDataFrame([], MANIFEST).columns).write.mode("append").parquet(f"{path}-manifest")
    delete_folder(spark, counted)
    return export_stats(manifest(spark, path))


def export_stats(done: DataFrame) -> DataFrame:
    seconds = F.coalesce(F.sum("seconds") / F.greatest(F.count("*"), F.lit(1)), F.lit(0.0))
    return done.agg(F.count("*").alias("chunks"), F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"), seconds.alias("seconds"), (F.sum("rows") / F.greatest(seconds, F.lit(1e-3))).alias("rows_per_second"))


def export_all(tables: dict[str, DataFrame], root: str, kind: str = "parquet", at_once: int = 2, **options) -> dict[str, DataFrame | str]:
    """Many exports, a few at a time; a failed one gives its error text, a mistake in the call is raised."""

    def one(item):
        try:
            return export(item[1], f"{root}/{item[0]}", kind, **options)
        except FAILURES as e:
            return f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(one, tables.items()), strict=True))


def request_key(request: dict) -> str:
    """SHA-256 of a request's canonical JSON."""
    return hashlib.sha256(json.dumps(request, sort_keys=True, separators=(",", ":"), default=str).encode()).hexdigest()


class ResultCache:
    """Results of SELECT requests as Parquet, found by the request, fresh for `ttl` seconds, cleared by table.

    Results no longer fresh are deleted `grace` seconds later, the time that readers of an old result have.
    """

    _SCHEMA = "key string, table string, path string, at double"

    def __init__(self, spark: SparkSession, root: str, ttl: float = 300.0, grace: float = 3600.0):
        self.spark, self.root, self.ttl, self.grace = spark, root.rstrip("/"), ttl, grace

    def _entries(self) -> DataFrame:
        try:
            return self.spark.read.schema(self._SCHEMA).option("recursiveFileLookup", True).option("ignoreMissingFiles", True).parquet(f"{self.root}/entries")
        except AnalysisException:
            return self.spark.createDataFrame([], self._SCHEMA)

    def _add(self, key: str, table: str, path: str | None) -> None:
        self.spark.createDataFrame([(key, table, path, time.time())], self._SCHEMA).coalesce(1).write.parquet(f"{self.root}/entries/{uuid.uuid4().hex}")

    def result(self, request: dict, table: str, build) -> DataFrame:
        """The stored result, or `build()` written and read back; what isn't a SELECT request is built each time and never stored."""
        if str(request.get("method", "select")).lower() != "select":
            return build()
        key = request_key(request)
        last = self._entries().where((F.col("key") == key) | ((F.col("table") == table) & F.col("path").isNull())).orderBy(F.col("at").desc()).first()
        if last is None or last.path is None or time.time() - last["at"] > self.ttl:
            path = f"{self.root}/{key}-{time.time_ns()}"
            build().write.parquet(path)
            self._add(key, table, path)
            self.sweep()
        else:
            path = last.path
        return self.spark.read.parquet(path)

    def sweep(self) -> int:
        """Delete what is out of date for longer than `grace`: results, then their entries, so a sweep cut short is finished by the next."""
        old = self._entries().where(F.col("at") < time.time() - self.ttl - self.grace).select("path", "_metadata.file_path").collect()
        for r in old:
            if r.path is not None:
                delete_folder(self.spark, r.path)
            delete_folder(self.spark, r.file_path.rpartition("/")[0])
        return len(old)

    def clear(self, table: str) -> None:
        self._add("", table, None)
