"""Joins, paging and column choice over DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .mapping import fields_of, output_name


def pick_fields(df: DataFrame, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """Only the included columns (all without a list), less the excluded ones; unknown names don't matter."""
    keep = [c for c in df.columns if (include is None or c in include) and c not in (exclude or [])]
    return df.select(*(F.col(f"`{c}`") for c in keep))


def without_match(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    """Rows of the left side that have no partner."""
    return left.join(right, on, "left_anti")


def with_match(left: DataFrame, right: DataFrame, on: Column) -> DataFrame:
    return left.join(right, on, "left_semi")


def join_related(df: DataFrame, related: DataFrame, key: str, related_key: str, name: str, many: bool = False) -> DataFrame:
    """A declared relationship: many-to-one as a struct column, one-to-many as an ordered array of structs.

    One-to-many is aggregated on its key before the join, so the table itself is shuffled once.
    """
    row = F.struct(*(F.col(f"`{c}`") for c in related.columns))
    if many:
        side = related.groupBy(F.col(related_key).alias("_related")).agg(F.array_sort(F.collect_list(row)).alias(name))
    else:
        side = related.select(F.col(related_key).alias("_related"), row.alias(name))
    return df.join(side, F.col(key) == F.col("_related"), "left").drop("_related")


def join_declared(df: DataFrame, schema: dict, tables: dict[str, DataFrame], schemas: dict[str, dict] | None = None) -> DataFrame:
    """The table with every relationship that schemas declare.

    A field with foreign_key "table.column" adds that row as a struct named after the table; with `schemas`, tables whose
    foreign keys point here are added as arrays of structs named `<table>_list`. Tables that aren't given are left out.
    """
    for p, f in sorted(fields_of(schema).items()):
        table, _, column = str(f.get("foreign_key") or "").partition(".")
        if column and table in tables:
            df = join_related(df, tables[table], output_name(schema, p), column, table)
    for name, other in (schemas or {}).items():
        for p, f in sorted(fields_of(other).items()):
            table, _, column = str(f.get("foreign_key") or "").partition(".")
            if column and table == schema["name"] and name in tables:
                df = join_related(df, tables[name], column, output_name(other, p), f"{name}_list", many=True)
    return df


def page(df: DataFrame, order_by: list[str], offset: int, limit: int) -> DataFrame:
    return df.orderBy(*order_by).offset(offset).limit(limit)


def keyset_page(df: DataFrame, key: str, last, limit: int) -> DataFrame:
    """The next rows after a key; the filter reaches the scan, so earlier pages aren't read."""
    rows = df if last is None else df.where(F.col(key) > F.lit(last))
    return rows.orderBy(key).limit(limit)


def scan_since(df: DataFrame, field: str, value, limit: int | None = None, inclusive: bool = False) -> DataFrame:
    """Rows after a checkpoint (strictly, unless `inclusive`), ordered only where a limit needs it."""
    rows = df if value is None else df.where(F.col(field) >= F.lit(value) if inclusive else F.col(field) > F.lit(value))
    return rows if limit is None else rows.orderBy(field).limit(limit)


def sample_rows(df: DataFrame, n: int, fraction: float | None = None, seed: int = 0) -> DataFrame:
    return (df if fraction is None else df.sample(fraction, seed)).limit(n)


def count_where(df: DataFrame, where: Column | None = None) -> DataFrame:
    return (df if where is None else df.where(where)).agg(F.count("*").alias("n"))


def read_synced(df: DataFrame, limit: int | None = None, offset: int = 0) -> DataFrame:
    """A synced table without its bookkeeping columns."""
    rows = df.drop(*(c for c in df.columns if c.startswith("_")))
    rows = rows.offset(offset) if offset else rows
    return rows if limit is None else rows.limit(limit)
