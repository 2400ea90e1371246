"""Tables written in order, with an index of row counts: a page far down is read without what stands before it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_ordered(df: DataFrame, order_by: list[str], path: str) -> None:
    """Rows in range partitions under `<path>/rows`, each file sorted, and (file, first, n) of each file under `<path>/index`.

    `first` is the number of rows in the files before. Only one row per file is summed over all. Rows that tie in the
    order stand as written, the same for every page.
    """
    df.repartitionByRange(*order_by).sortWithinPartitions(*order_by).write.parquet(f"{path}/rows")
    rows = df.sparkSession.read.schema(df.schema).parquet(f"{path}/rows")
    sizes = rows.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count("*").alias("n"), F.min(F.struct(*(F.col(f"`{c}`") for c in order_by))).alias("least"))
    before = Window.orderBy("least", "file").rowsBetween(Window.unboundedPreceding, -1)
    sizes.select("file", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), "n").write.parquet(f"{path}/index")


def read_numbered(spark: SparkSession, path: str, first: int = 0, end: int | None = None) -> DataFrame:
    """Rows `first` (from 0) up to `end` with their numbers (`_row`), from the files that hold them alone.

    A row's number is its file's first one and its place in the file, which the reader knows; nothing is sorted.
    """
    index = spark.read.parquet(f"{path}/index").where(F.col("first") + F.col("n") > first)
    if end is not None:
        index = index.where(F.col("first") < end)
    schema = spark.read.parquet(f"{path}/rows").schema
    files = index.select("file").collect() if end is not None else []
    if end is not None and not files:
        return spark.createDataFrame([], schema).withColumn("_row", F.lit(0).cast("long"))
    rows = spark.read.schema(schema).parquet(*(f"{path}/rows/{r.file}" for r in files) if files else (f"{path}/rows",))
    placed = rows.select("*", F.col("_metadata.file_name").alias("_file"), F.col("_metadata.row_index").alias("_place"))
    placed = placed.join(F.broadcast(index), F.col("_file") == F.col("file")).withColumn("_row", F.col("first") + F.col("_place"))
    kept = placed.where(F.col("_row") >= first) if end is None else placed.where(F.col("_row").between(first, end - 1))
    return kept.select(*(f"`{c}`" for c in schema.names), "_row")


def read_page(spark: SparkSession, path: str, offset: int, limit: int) -> DataFrame:
    """The rows from `offset` on, `limit` at most, in order."""
    return read_numbered(spark, path, offset, offset + limit).orderBy("_row").drop("_row")
