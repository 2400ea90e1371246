"""Data-quality checks: mapping match, constraints, references, schema drift."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _q(name: str) -> Column:
    return F.col(f"`{name}`")


def verdict(ratio: Column) -> Column:
    return F.when(ratio >= 0.95, "pass").when(ratio >= 0.80, "warn").otherwise("fail")


def match_ratio(left: DataFrame, right: DataFrame, key: str, left_col: str, right_col: str) -> DataFrame:
    """One row: rows compared (joined on the key), matches (null equals null), ratio, verdict and figures of the left column."""
    return validate_mapping(left, right, key, {left_col: right_col}).drop("error")


def validate_mapping(left: DataFrame, right: DataFrame, key: str, mappings: dict[str, str]) -> DataFrame:
    """A row per mapping of a left to a right column, all from one join; an unknown column is a row with an error."""
    known = {a: b for a, b in mappings.items() if a in left.columns and b in right.columns}
    spark = left.sparkSession
    schema = "left_col string, right_col string, rows long, matches long, match_ratio double, verdict string, null_count long, unique_count long, min_value string, max_value string, error string"
    bad = [(a, b, None, None, None, "fail", None, None, None, None, f"unknown column {a if a not in left.columns else b}") for a, b in mappings.items() if a not in known]
    failed = spark.createDataFrame(bad, schema)
    if not known:
        return failed
    pairs = left.select(_q(key).alias("k"), *(_q(a).alias(f"l{i}") for i, a in enumerate(known))).join(
        right.select(_q(key).alias("k"), *(_q(b).alias(f"r{i}") for i, b in enumerate(known.values()))), "k"
    )
    cells = []
    for i, (a, b) in enumerate(known.items()):
        x, y = F.col(f"l{i}"), F.col(f"r{i}")
        same = x.cast("string").eqNullSafe(y.cast("string"))
        cells.append(
            F.struct(
                F.lit(a).alias("left_col"), F.lit(b).alias("right_col"), F.count("*").alias("rows"), F.count_if(same).alias("matches"),
                F.avg(F.when(same, 1.0).otherwise(0.0)).alias("match_ratio"), F.count_if(x.isNull()).alias("null_count"),
                F.min(x).cast("string").alias("min_value"), F.max(x).cast("string").alias("max_value"),
            )
        )
    done = pairs.agg(F.array(*cells).alias("m")).select(F.explode("m").alias("m")).select("m.*")
    # Distinct values by unpivot and two groupings: a count of distinct values per mapping in one aggregate would multiply the rows.
    values = pairs.select(*(F.col(f"l{i}").cast("string").alias(f"{i}") for i in range(len(known)))).unpivot([], [_q(str(i)) for i in range(len(known))], "place", "value")
    distinct = values.where("value IS NOT NULL").groupBy("place", "value").agg(F.lit(1)).groupBy("place").agg(F.count("*").alias("unique_count"))
    place = F.array_position(F.array(*map(F.lit, known)), F.col("left_col")) - 1
    done = done.join(distinct, place == F.col("place"), "left").withColumn("unique_count", F.coalesce("unique_count", F.lit(0).cast("long")))
    done = done.withColumns({"verdict": verdict(F.coalesce("match_ratio", F.lit(0.0))), "error": F.lit(None).cast("string")})
    return done.select(*failed.columns).unionByName(failed)


def rules_of(name: str, constraints: dict) -> dict[str, Column]:
    """Violation test of each constraint of a column (nulls break `not_null` only)."""
    c = _q(name)
    size = F.length(c.cast("string"))
    tests: dict[str, Callable] = {
        "not_null": lambda v: c.isNull(),
        "min_length": lambda v: size < v,
        "max_length": lambda v: size > v,
        "ge": lambda v: c < v,
        "le": lambda v: c > v,
        "gt": lambda v: c <= v,
        "lt": lambda v: c >= v,
        "not_blank": lambda v: F.length(F.trim(c.cast("string"))) == 0,
        "validator": lambda v: ~v(c),
    }
    return {k: tests[k](v) for k, v in constraints.items() if k in tests and v is not None and v is not False}


def check_constraints(df: DataFrame, constraints: dict[str, dict]) -> DataFrame:
    """(column_name, rule, violations): row rules in one pass, `unique` and `primary_key` by grouping.

    `violations` of unique counts the rows beyond the first of each value (nulls don't count);
    primary_key adds the null keys.
    """
    row_rules = [(c, r, test) for c, spec in constraints.items() for r, test in rules_of(c, spec).items()]
    parts = []
    if row_rules:
        cells = [F.struct(F.lit(c).alias("column_name"), F.lit(r).alias("rule"), F.count_if(F.coalesce(t, F.lit(False))).alias("violations")) for c, r, t in row_rules]
        parts.append(df.agg(F.array(*cells).alias("v")).select(F.explode("v").alias("v")).select("v.*"))
    for c, spec in constraints.items():
        for rule in ("unique", "primary_key"):
            if spec.get(rule):
                groups = df.groupBy(_q(c).alias("k")).agg(F.count("*").alias("n"))
                extra = F.when(F.col("k").isNotNull(), F.col("n") - 1).otherwise(F.col("n") if rule == "primary_key" else 0)
                parts.append(groups.agg(F.coalesce(F.sum(extra), F.lit(0)).alias("violations")).select(F.lit(c).alias("column_name"), F.lit(rule).alias("rule"), "violations"))
    out = df.sparkSession.createDataFrame([], "column_name string, rule string, violations long")
    for p in parts:
        out = out.unionByName(p)
    return out


def violating_rows(df: DataFrame, constraints: dict[str, dict], limit: int = 20) -> DataFrame:
    """Sample rows that break a row rule, with the list of broken rules."""
    tests = [F.when(F.coalesce(t, F.lit(False)), F.lit(f"{c}:{r}")) for c, spec in constraints.items() for r, t in rules_of(c, spec).items()]
    broken = F.filter(F.array(*tests), lambda x: x.isNotNull())
    return df.withColumn("broken", broken).where(F.size("broken") > 0).limit(limit)


def orphans(child: DataFrame, parent: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows whose non-null reference has no parent."""
    keys = parent.select(_q(pk).alias("_pk"))
    return child.where(_q(fk).isNotNull()).join(keys, _q(fk) == F.col("_pk"), "left_anti")


def field_mappings(df: DataFrame) -> DataFrame:
    """(position, field, type) of a table's columns."""
    rows = [(i, f.name, f.dataType.simpleString()) for i, f in enumerate(df.schema)]
    return df.sparkSession.createDataFrame(rows, "position int, field string, type string")


def fingerprint(mappings: DataFrame) -> DataFrame:
    """md5 of the ordered field list."""
    fields = F.array_sort(F.collect_list(F.struct("position", "field", "type")))
    return mappings.agg(F.md5(F.to_json(fields)).alias("fingerprint"))


def schema_drift(old: DataFrame, new: DataFrame) -> DataFrame:
    """(field, change): added, removed, retyped or moved fields between two versions of a table."""
    a = field_mappings(old).select("field", F.col("position").alias("p1"), F.col("type").alias("t1"))
    b = field_mappings(new).select("field", F.col("position").alias("p2"), F.col("type").alias("t2"))
    both = a.join(b, "field", "full_outer")
    change = F.when(F.col("p1").isNull(), "added").when(F.col("p2").isNull(), "removed").when(F.col("t1") != F.col("t2"), "retyped").when(F.col("p1") != F.col("p2"), "moved")
    return both.select("field", change.alias("change"), "t1", "t2").where(F.col("change").isNotNull())
