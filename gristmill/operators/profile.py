"""Table metadata, column profiles, type and meaning inference, ingest policy."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..failures import FAILURES
from ..functions.predicates import live_rows_sql


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def table_metadata(df: DataFrame, id_field: str = "id") -> DataFrame:
    """One row, one pass: row_count, min_id, max_id, and min and max of each date or timestamp column."""
    out = [F.count("*").alias("row_count")]
    if id_field in df.columns:
        out += [F.min(_q(id_field)).alias("min_id"), F.max(_q(id_field)).alias("max_id")]
    for f in df.schema:
        if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            out += [F.min(_q(f.name)).alias(f"min_{f.name}"), F.max(_q(f.name)).alias(f"max_{f.name}")]
    return df.agg(*out)


def value_counts(df: DataFrame) -> DataFrame:
    """(column_name, value, n): each column's values as text with their counts, nulls too.

    Columns are unpivoted and counted with partial aggregation, so distinct values are shuffled
    rather than cells.
    """
    cells = df.select(*(_q(c).cast("string").alias(c) for c in df.columns))
    long = cells.unpivot([], [_q(c) for c in df.columns], "column_name", "value")
    return long.groupBy("column_name", "value").agg(F.count("*").alias("n"))


def profile(df: DataFrame, top: int = 5, top_up_to: int = 20) -> DataFrame:
    """Per column: size, null_count, null_percentage, unique_count, cardinality, top_values.

    top_values: the commonest values with counts, for columns of at most `top_up_to` distinct ones;
    ties by value. Exact; one shuffle of distinct values and one of columns.
    """
    counts = value_counts(df)
    present = F.col("value").isNotNull()
    by = counts.groupBy("column_name").agg(
        F.sum("n").alias("size"),
        F.coalesce(F.sum(F.when(~present, F.col("n"))), F.lit(0)).alias("null_count"),
        F.count(F.when(present, 1)).alias("unique_count"),
    )
    order = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    best = counts.where(present).withColumn("r", F.row_number().over(order)).where(F.col("r") <= top)
    tops = best.groupBy("column_name").agg(F.array_sort(F.collect_list(F.struct("r", "value", "n"))).alias("t"))
    listed = F.when(F.col("unique_count") <= top_up_to, F.transform("t", lambda x: F.struct(x["value"].alias("value"), x["n"].alias("n"))))
    return by.join(tops, "column_name", "left").select(
        "column_name",
        "size",
        "null_count",
        (100.0 * F.col("null_count") / F.col("size")).alias("null_percentage"),
        "unique_count",
        (F.col("unique_count") / F.col("size")).alias("cardinality"),
        listed.alias("top_values"),
    )


def _per_column(df: DataFrame, names: list[str], measures: dict) -> DataFrame:
    """One row per column from one aggregate over the table; `measures`: output -> function of a Column."""
    cells = [F.struct(F.lit(c).alias("column_name"), *(f(_q(c)).alias(n) for n, f in measures.items())) for c in names]
    return df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def profile_numeric(df: DataFrame) -> DataFrame:
    """min, max and mean of the numeric columns."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    return _per_column(df, names, {"min_value": lambda c: F.min(c).cast("double"), "max_value": lambda c: F.max(c).cast("double"), "avg_value": lambda c: F.avg(c).cast("double")})


def profile_strings(df: DataFrame) -> DataFrame:
    """Least, greatest and mean length of the string columns."""
    names = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return _per_column(df, names, {"min_length": lambda c: F.min(F.length(c)), "max_length": lambda c: F.max(F.length(c)), "avg_length": lambda c: F.avg(F.length(c))})


#: Narrowest first; `date` only if every value is a date alone.
_KINDS = ("integer", "float", "boolean", "date", "datetime")
# Patterns that tell what a column means.
EMAIL = r"^[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}$"
URL = r"^https?://\S+$"
UUID = r"^[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{4}-[0-9a-f]{12}$"
PHONE = r"^\+?[1-9]\d{1,14}$"
EIGHT_DIGITS = r"^\d{8}$"
DATE_ONLY = r"^\d{4}-\d{2}-\d{2}$"


#: Types of columns that need no look at their values.
_SETTLED = ((T.IntegralType, "integer"), ((T.FloatType, T.DoubleType), "float"), (T.BooleanType, "boolean"), (T.DateType, "date"), ((T.TimestampType, T.TimestampNTZType), "datetime"))
_DIGITS = r"^\s*[+-]?[0-9]+\s*$"
_NUMBER = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+|[nN][aA][nN]|[iI][nN][fF](?:[iI][nN][iI][tT][yY])?)(?:[eE][+-]?[0-9]+)?[fFdD]?\s*$"


def _fits(c: Column, kind: str) -> Column:
    """Patterns come first: a cast that fails raises inside, which costs far more than a look at the characters."""
    if kind == "date":
        return c.rlike(DATE_ONLY) & c.try_cast("date").isNotNull()
    if kind == "boolean":
        return F.lower(c).isin("true", "false")
    if kind == "datetime":
        return c.rlike(r"^\d{4}-\d{2}-\d{2}") & c.try_cast("timestamp").isNotNull()
    pattern, spark_type = {"integer": (_DIGITS, "bigint"), "float": (_NUMBER, "double")}[kind]
    return c.rlike(pattern) & c.try_cast(spark_type).isNotNull()


def _share(c: Column, test) -> Column:
    """Share of the non-null values that pass a test; null without values."""
    return F.avg(F.when(c.isNotNull(), F.when(test(c.cast("string")), 1.0).otherwise(0.0)))


def _shares(df: DataFrame, meanings: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """Per column the share of values that fit each kind and show each meaning, and the number of values (`present`): one aggregate.

    A column whose own type says what it is gets that kind and no meaning, without a look at its values.
    """
    cells = []
    for f in df.schema:
        c = _q(f.name)
        settled = next((k for cls, k in _SETTLED if isinstance(f.dataType, cls)), None)
        if settled:
            shares = [F.lit(float(k == settled)).alias(k) for k in (*_KINDS, *meanings)]
        else:
            shares = [_share(c, lambda x, k=k: _fits(x, k)).alias(k) for k in _KINDS] + [_share(c, lambda x, t=t: t(F.trim(x))).alias(k) for k, t in meanings.items()]
        cells.append(F.struct(F.lit(f.name).alias("column_name"), *shares, F.count(c).alias("present")))
    return df.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def _kind() -> Column:
    kind = reduce(lambda later, k: F.when(F.col(k) == 1.0, k).otherwise(later), _KINDS[::-1], F.lit("string"))
    return F.when(F.col("present") == 0, "unknown").otherwise(kind)


def _place(df: DataFrame) -> Column:
    return F.array_position(F.array(*map(F.lit, df.columns)), F.col("column_name")).cast("int") - 1


def infer_types(df: DataFrame) -> DataFrame:
    """(position, column_name, inferred_type): the narrowest type that all non-null values fit; unknown without values."""
    return _shares(df, {}).select(_place(df).alias("position"), "column_name", _kind().alias("inferred_type"))


def classify_columns(df: DataFrame, threshold: float = 0.9) -> DataFrame:
    """(position, column_name, inferred_type, inferred_name): what each column means, over all its values.

    A meaning holds if at least `threshold` of the non-null values show it. Repeated names get `_<position>`. Types
    and meanings come from one aggregate over the table.
    """

    def phone(c):
        clean = F.regexp_replace(c, r"[ ()-]", "")
        return clean.rlike(PHONE) & ~clean.rlike(EIGHT_DIGITS)

    tests = {"email": lambda c: c.rlike(EMAIL), "url": lambda c: c.rlike(URL), "uuid": lambda c: F.lower(c).rlike(UUID), "phone": phone}
    kinds = _shares(df, tests).na.fill(0.0, list(tests)).select("column_name", *tests, _place(df).alias("position"), _kind().alias("inferred_type"))
    numbers = [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]
    p, kind, own = F.col("position"), F.col("inferred_type"), F.concat(F.lit("Field_"), F.col("position"))
    name = (
        F.when((p == 0) & (kind == "integer"), "id")
        .when(F.col("column_name").isin(numbers) if numbers else F.lit(False), own)
        .when(F.col("email") >= threshold, "email")
        .when(F.col("url") >= threshold, "url")
        .when(F.col("uuid") >= threshold, "uuid")
        .when((F.col("phone") >= threshold), "phone")
        .when((kind == "datetime") & (p == 1), "created_at")
        .when((kind == "datetime") & (p == 2), "updated_at")
        .when(kind == "datetime", F.concat(F.lit("timestamp_"), p))
        .when(kind == "date", F.concat(F.lit("date_"), p))
        .otherwise(own)
    )
    named = kinds.select("position", "column_name", "inferred_type", name.alias("n"))
    again = F.row_number().over(Window.partitionBy("n").orderBy("position")) > 1
    return named.select("position", "column_name", "inferred_type", F.when(again, F.concat_ws("_", "n", "position")).otherwise(F.col("n")).alias("inferred_name"))


def ingest_policy(metadata: DataFrame) -> DataFrame:
    """Chunk size, strategy, automatic sync and lifetime from (row_count[, has_update_time]).

    Above 10000 rows a table with an update time is loaded incrementally; the limit is twice the rows.
    """
    n = F.coalesce("row_count", F.lit(0))
    updated = F.coalesce("has_update_time", F.lit(False)) if "has_update_time" in metadata.columns else F.lit(False)
    return metadata.withColumns(
        {
            "chunk_size": F.when(n < 1000, F.greatest(n, F.lit(100))).when(n < 100000, 5000).otherwise(10000).cast("long"),
            "strategy": F.when((n >= 100000) | ((n > 10000) & updated), "incremental").otherwise("full"),
            "auto_sync": n < 100000,
            "ttl": F.when(n < 1000, 3600).when(n < 100000, 1800).otherwise(600).cast("long"),
            "row_limit": (2 * n).cast("long"),
        }
    )


#: Column names that tell when a row was last changed.
UPDATE_NAMES = ("updated_at", "modified_at", "update_time")


def policy_metadata(df: DataFrame, name: str) -> DataFrame:
    """One row for `ingest_policy`: table_name, row_count, has_update_time, incremental_field and the predicate of live rows as SQL text."""
    update = next((c for c in df.columns if c.lower() in UPDATE_NAMES), None)
    return df.agg(F.count("*").alias("row_count")).select(
        F.lit(name).alias("table_name"),
        "row_count",
        F.lit(update is not None).alias("has_update_time"),
        F.lit(update).cast("string").alias("incremental_field"),
        F.lit(live_rows_sql(df)).cast("string").alias("where"),
    )


def introspect_all(tables: dict[str, DataFrame], job=profile, at_once: int = 3) -> dict[str, DataFrame | str]:
    """A job per table, a few at a time; a table that fails, also while it runs, gives its error text instead of a DataFrame.

    Results are profiles: a row per table or column, held on the driver. A mistake in `job` itself is raised.
    """

    def one(df: DataFrame):
        try:
            out = job(df)
            return out.sparkSession.createDataFrame(out.collect(), out.schema)
        except FAILURES as e:  # one table must not end the others
            return f"{type(e).__name__}: {e}"

    with ThreadPoolExecutor(at_once) as pool:
        return dict(zip(tables, pool.map(one, tables.values()), strict=True))
