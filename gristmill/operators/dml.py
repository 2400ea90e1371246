"""Row modification as copy-on-write: each function returns (new table, RETURNING rows)."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _returning(df: DataFrame, columns: str | list[str] | None) -> DataFrame:
    return df.select(*([columns] if isinstance(columns, str) else columns)) if columns else df.limit(0)


def _matched(where: Column | None) -> Column:
    """A null predicate is no match; no predicate matches all rows."""
    return F.lit(True) if where is None else F.coalesce(where, F.lit(False))


def insert_rows(df: DataFrame, columns: list[str], values: list[list[Any]] | DataFrame, returning=None) -> tuple[DataFrame, DataFrame]:
    """Append rows given by column list; columns that aren't listed are null."""
    if isinstance(values, DataFrame):
        new = values.toDF(*columns)
    else:
        new = df.sparkSession.createDataFrame([tuple(v) for v in values], df.select(*columns).schema)
    types = {f.name: f.dataType for f in df.schema}
    full = new.select(*((F.col(f"`{c}`") if c in columns else F.lit(None)).cast(types[c]).alias(c) for c in df.columns))
    return df.unionByName(full), _returning(full, returning)


def update_rows(df: DataFrame, changes: dict[str, Any], where: Column | None = None, returning=None) -> tuple[DataFrame, DataFrame]:
    """SET columns (values or expressions over the old row) where the predicate is true; after-image returned."""
    hit = _matched(where)
    types = {f.name: f.dataType for f in df.schema}
    values = {c: (v if isinstance(v, Column) else F.lit(v)).cast(types[c]) for c, v in changes.items()}
    new = df.select(*(F.when(hit, values[c]).otherwise(F.col(f"`{c}`")).alias(c) if c in values else F.col(f"`{c}`") for c in df.columns))
    after = df.where(hit).select(*(values.get(c, F.col(f"`{c}`")).alias(c) for c in df.columns))
    return new, _returning(after, returning)


def delete_rows(df: DataFrame, where: Column | None = None, returning=None) -> tuple[DataFrame, DataFrame]:
    """Drop rows where the predicate is true; before-image returned."""
    hit = _matched(where)
    return df.where(~hit), _returning(df.where(hit), returning)


def truncate(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The empty table, and one row with the number of rows removed."""
    return df.limit(0), df.agg(F.count("*").alias("removed"))
