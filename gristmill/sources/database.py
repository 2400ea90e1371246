"""Partitioned scans of database tables over JDBC."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def scan_database(spark: SparkSession, url: str, table: str, key: str | None = None, partitions: int = 8, where: str | None = None, properties: dict[str, str] | None = None) -> DataFrame:
    """A table read in key ranges, one task each; without a key by one task.

    The bounds of the numeric key are asked of the database first, as one row. `where` is SQL of the database and is
    worked out there, like the filters and column choice of later steps. Rows with a null key are read by the first task.
    """
    source = f"(SELECT * FROM {table} WHERE {where}) AS rows_of_table" if where else table
    if key is None:
        return spark.read.jdbc(url, source, properties=properties)
    condition = f" WHERE {where}" if where else ""
    low, high = spark.read.jdbc(url, f"(SELECT min({key}) AS low, max({key}) AS high FROM {table}{condition}) AS bounds", properties=properties).first()
    if low is None:
        return spark.read.jdbc(url, source, properties=properties)
    return spark.read.jdbc(url, source, column=key, lowerBound=int(low), upperBound=int(high) + 1, numPartitions=partitions, properties=properties)
