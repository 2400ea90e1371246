"""Aggregates with PostgreSQL meaning: distinct pairs count rows with nulls, lists keep nulls and are ordered."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import col


def count_rows() -> Column:
    return F.count("*")


def count_distinct(*cs: Column | str) -> Column:
    """Of one column without nulls; of several, rows with a null count as values."""
    return F.count_distinct(col(cs[0])) if len(cs) == 1 else F.count_distinct(F.struct(*map(col, cs)))


def of_distinct(name: str, c: Column | str) -> Column:
    """SUM, AVG, MIN or MAX over distinct values."""
    c = col(c)
    if name in ("min", "max"):
        return getattr(F, name)(c)
    if name == "sum":
        return F.sum_distinct(c)
    # The mean of distinct values from their sum and count, which share one distinct pass.
    return F.sum_distinct(c).cast("double") / F.count_distinct(c)


def array_agg(c: Column | str) -> Column:
    """All values, nulls too, in ascending order with nulls last."""
    return F.transform(F.array_sort(F.collect_list(F.struct(col(c).isNull().alias("n"), col(c).alias("v")))), lambda s: s["v"])


def string_agg(c: Column | str, separator: str) -> Column:
    """Non-null values as text, in ascending order; null if there is none."""
    values = F.array_sort(F.collect_list(col(c).cast("string")))
    return F.when(F.size(values) > 0, F.array_join(values, separator))


def json_agg(c: Column | str) -> Column:
    return F.to_json(array_agg(c))


AGGREGATES = {
    "count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max, "stddev": F.stddev_samp, "variance": F.var_samp,
    "bool_and": F.bool_and, "bool_or": F.bool_or, "every": F.every, "array_agg": array_agg, "json_agg": json_agg, "jsonb_agg": json_agg,
}
