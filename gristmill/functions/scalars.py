"""Scalar functions with PostgreSQL meaning where Spark's differs."""

from __future__ import annotations

import re
from functools import reduce
from operator import add as _add
from operator import mul as _mul

from pyspark.sql import Column
from pyspark.sql import functions as F

from .predicates import col


def add(*xs: Column | str) -> Column:
    return reduce(_add, map(col, xs))


def sub(a: Column | str, b: Column | str) -> Column:
    return col(a) - col(b)


def mul(*xs: Column | str) -> Column:
    return reduce(_mul, map(col, xs))


def div(a: Column | str, b: Column | str, integers: bool = False) -> Column:
    """Division; of integers it truncates towards zero."""
    return F.call_function("div", col(a), col(b)) if integers else col(a) / col(b)


def mod(a: Column | str, b: Column | str) -> Column:
    """Remainder with the sign of the dividend."""
    return col(a) % col(b)


def regexp_replace_first(c: Column | str, pattern: str, replacement: str) -> Column:
    r"""Replace the first match only; `\1` or `$1` in the replacement are groups of the pattern.

    The text before the match is held in a group of its own, so back-references move up by one.
    """
    shifted = re.sub(r"\\(\d)|\$(\d)", lambda m: f"${int(m[1] or m[2]) + 1}", replacement)
    moved = re.sub(r"(?<!\\)\\(\d)", lambda m: f"\\{int(m[1]) + 1}", pattern)
    return F.regexp_replace(col(c), f"^([\\s\\S]*?)(?:{moved})", "$1" + shifted)


def to_date(c: Column | str) -> Column:
    return F.to_date(col(c))


def parse_datetime(c: Column | str) -> Column:
    """ISO date-time; null where it can't be read."""
    return F.try_to_timestamp(col(c).cast("string"))


def parse_date(c: Column | str) -> Column:
    return F.to_date(parse_datetime(c))


def convert(c: Column | str, kind: str) -> Column:
    """Value as integer, float, boolean, string, datetime, date, json (checked text) or variant (parsed JSON); null on failure."""
    c = col(c)
    if kind in ("datetime", "date"):
        return parse_datetime(c) if kind == "datetime" else parse_date(c)
    if kind == "variant":
        return F.try_parse_json(c.cast("string"))
    if kind == "json":
        return F.when(F.try_parse_json(c.cast("string")).isNotNull(), c.cast("string"))
    spark_type = {"integer": "bigint", "float": "double", "boolean": "boolean", "string": "string", "unknown": "string"}[kind]
    return c.cast("string") if spark_type == "string" else c.try_cast(spark_type)


def trimmed(c: Column | str) -> Column:
    return F.trim(col(c))


def not_blank(c: Column | str) -> Column:
    """False for a null or a text of blanks."""
    return F.coalesce(F.length(F.trim(col(c))) > 0, F.lit(False))


def call(name: str, *args: Column | str) -> Column:
    """Any built-in by name; an unknown one fails when the query is analysed."""
    return F.call_function(name.lower(), *map(col, args))
