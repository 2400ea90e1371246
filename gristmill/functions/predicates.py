"""Predicates as Column expressions: comparisons, IS, LIKE, IN, lookups, row flags, SQL text."""

from __future__ import annotations

from functools import reduce
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_value(c: Column | str, value: bool | None) -> Column:
    """IS NULL, IS TRUE, IS FALSE: never null itself."""
    return col(c).isNull() if value is None else col(c).eqNullSafe(F.lit(value))


def is_not_value(c: Column | str, value: bool | None) -> Column:
    return ~is_value(c, value)


def all_of(*conditions: Column) -> Column:
    """AND of any number of conditions; none is true."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True)) if conditions else F.lit(True)


def any_of(*conditions: Column) -> Column:
    """OR of any number of conditions; none is false."""
    return reduce(lambda a, b: a | b, conditions) if conditions else F.lit(False)


def contains_text(c: Column | str, part: str) -> Column:
    """Case-insensitive; `%` and `_` in the argument stay wildcards."""
    return col(c).ilike(f"%{part}%")


def starts_with_text(c: Column | str, part: str) -> Column:
    return col(c).ilike(f"{part}%")


def in_values(c: Column | str, values: list | DataFrame) -> Column:
    """IN a list or a one-column DataFrame (null-aware, also when negated)."""
    return col(c).isin(values)


LOOKUPS = {
    "eq": lambda c, v: c == v,
    "ne": lambda c, v: c != v,
    "neq": lambda c, v: c != v,
    "gt": lambda c, v: c > v,
    "gte": lambda c, v: c >= v,
    "lt": lambda c, v: c < v,
    "lte": lambda c, v: c <= v,
    "like": lambda c, v: c.like(v),
    "ilike": lambda c, v: c.ilike(v),
    "contains": contains_text,
    "startswith": starts_with_text,
    "in": lambda c, v: in_values(c, v if isinstance(v, DataFrame) else list(v)),
    "isnull": lambda c, v: c.isNull() if v else c.isNotNull(),
    "is": is_value,
    "is_not": is_not_value,
}


def lookup_filter(**lookups: Any) -> Column:
    """`name=v`, `name__gte=v`, `name__in=[...]`, joined by AND; combine results with `&`, `|` and `~`."""
    parts = []
    for key, value in lookups.items():
        name, _, kind = key.rpartition("__")
        if not name or kind not in LOOKUPS:
            name, kind = key, "is" if value is None else "eq"
        parts.append(LOOKUPS[kind](F.col(name), value))
    return all_of(*parts)


def live_rows_sql(df: DataFrame) -> str | None:
    """The predicate of `live_rows` as SQL text; none without flags."""
    parts = []
    deleted = next((f.name for f in df.schema if "deleted" in f.name.lower()), None)
    if deleted is not None:
        parts.append(f"`{deleted}` IS NULL")
    for f in df.schema:
        if isinstance(f.dataType, T.BooleanType) and f.name.lower() in ("disabled", "archived", "active", "enabled"):
            parts.append(f"`{f.name}` = {'false' if f.name.lower() in ('disabled', 'archived') else 'true'}")
    return " AND ".join(parts) or None


def live_rows(df: DataFrame) -> Column:
    """Rows that no flag marks as gone.

    The first column whose name contains `deleted` must be null; boolean `disabled` and `archived`
    must be false, `active` and `enabled` true. A null flag doesn't pass.
    """
    text = live_rows_sql(df)
    return F.lit(True) if text is None else F.expr(text)


def where_sql(df: DataFrame, predicate: str | None) -> DataFrame:
    """Rows for which a predicate given as SQL text holds; no text, all rows."""
    return df.where(F.expr(predicate)) if predicate else df
