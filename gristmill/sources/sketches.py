"""Approximate column profiles that grow with a stored table: sketches per folder, merged when they are asked for."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.mapping import BOOKKEEPING
from .state import Store

#: Logarithm of the registers of a distinct-value sketch (relative error about 1.04 / sqrt(2^k)) and size of a quantile sketch (rank error about 1.3 % at 200).
LOG_REGISTERS, QUANTILE_SIZE = 14, 400
SKETCHES = "folder string, column_name string, size long, present long, values binary, numbers binary"


def _cells(df: DataFrame) -> list[Column]:
    """One struct of sketches per data column."""
    out = []
    for f in df.schema:
        if f.name in BOOKKEEPING or f.name.startswith("_"):
            continue
        c = F.col(f"`{f.name}`")
        numbers = F.kll_sketch_agg_double(c.cast("double"), F.lit(QUANTILE_SIZE)) if isinstance(f.dataType, T.NumericType) else F.lit(None).cast("binary")
        out.append(F.struct(F.lit(f.name).alias("column_name"), F.count("*").alias("size"), F.count(c).alias("present"), F.hll_sketch_agg(c.cast("string"), F.lit(LOG_REGISTERS)).alias("values"), numbers.alias("numbers")))
    return out


def sketched(df: DataFrame, folder: Column | None = None) -> DataFrame:
    """Sketches of a table's columns, for all rows or for each folder they lie in; one aggregate with partial sketches."""
    cells = F.array(*_cells(df)).alias("c")
    each = df.agg(cells).withColumn("folder", F.lit("")) if folder is None else df.groupBy(folder.alias("folder")).agg(cells)
    return each.select("folder", F.explode("c").alias("c")).select("folder", "c.*")


def merged(sketches: DataFrame) -> DataFrame:
    """(column_name, size, null_count, unique_count, quantiles): from the sketches of all parts.

    unique_count is estimated (exact up to some thousand values); quantiles are least, lower quartile, median, upper quartile and greatest of
    numeric columns, by rank within the sketch's bound.
    """
    by = sketches.groupBy("column_name").agg(F.sum("size").alias("size"), F.sum("present").alias("present"), F.hll_union_agg("values").alias("values"), F.kll_merge_agg_double("numbers").alias("numbers"))
    ranks = F.array(*(F.lit(x) for x in (0.0, 0.25, 0.5, 0.75, 1.0)))
    some = F.coalesce(F.kll_sketch_get_n_double("numbers"), F.lit(0)) > 0
    return by.select("column_name", "size", (F.col("size") - F.col("present")).alias("null_count"), F.hll_sketch_estimate("values").alias("unique_count"), F.when(some, F.kll_sketch_get_quantile_double("numbers", ranks)).alias("quantiles"))


def approximate_profile(df: DataFrame) -> DataFrame:
    return merged(sketched(df))


def profile_stored(store: Store, table: str) -> DataFrame:
    """The approximate profile of a stored table; only folders without sketches, written since the last profile, are read.

    Sketches lie under `<table>/sketches` with the name of the folder they describe. Those of folders that the current
    version doesn't have any more don't count.
    """
    spark, base = store.spark, f"{store.root}/{table}"
    folders = sorted(set(store.files(table).values()))
    known = store.sketches(table, SKETCHES)
    missing = [r.folder for r in spark.createDataFrame([(d,) for d in folders], "folder string").join(known.select("folder").distinct(), "folder", "left_anti").collect()]
    if missing:
        rows = store.rows_of(table, missing)
        folder = F.regexp_extract(F.col("_metadata.file_path"), r"(data/[0-9a-f]{32}(?:/_bucket=\d+)?)/[^/]*$", 1)
        sketched(rows.select("*", folder.alias("_folder")), F.col("_folder")).write.parquet(f"{base}/sketches/{uuid.uuid4().hex}")
        known = store.sketches(table, SKETCHES)
    return merged(known.where(F.col("folder").isin(folders)))
