"""Continuous incremental sync: a file stream merged batch by batch into a stored table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.state import Store


def stream_into(store: Store, source_path: str, schema, table: str, key: str, order: str, checkpoint: str, files_per_batch: int = 1, buckets: int = 0) -> DataFrame:
    """Merge all files that aren't merged yet and return the table.

    Files may come in any order: of the rows of a key the greatest in `order` stays. The stream's checkpoint
    replaces a stored one. A batch that was merged before a failure is recognised by its number, which is
    kept in the table's commit log, so it never raises versions twice. Two versions are kept. With `buckets` a
    batch rewrites only those hash buckets of the key that it falls into.
    """
    spark: SparkSession = store.spark

    def merge(batch: DataFrame, number: int) -> None:
        merged = store.last_batch(table)
        if merged is None or merged < number:
            store.merge(table, batch, key, order, batch=number, keep=2, buckets=buckets)

    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(source_path)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return store.read(table)
