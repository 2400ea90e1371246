"""JSON text as values: parsed once into VARIANT, read by path, with the types of all paths found from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.predicates import col

_TYPES = {"integer": "bigint", "float": "double", "boolean": "boolean", "string": "string"}


def parsed(c: Column | str) -> Column:
    """The value of a JSON text as VARIANT; null where it is no JSON."""
    return F.try_parse_json(col(c).cast("string"))


def path_of(*names: str | int) -> str:
    """A path from field names and places in arrays. Spark has no path to a name with quotes of both kinds."""
    parts = []
    for x in names:
        if isinstance(x, int):
            parts.append(f"[{x}]")
        elif "'" not in x:
            parts.append(f"['{x}']")
        elif '"' not in x:
            parts.append(f'["{x}"]')
        else:
            raise ValueError(f"no path to the field {x!r}")
    return "$" + "".join(parts)


def value_at(c: Column | str, names: list[str | int], kind: str = "string") -> Column:
    """The value at a path of a parsed column, as integer, float, boolean or string; null if it isn't there or doesn't fit."""
    return F.try_variant_get(col(c), path_of(*names), _TYPES[kind])


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.IntegralType):
        return "integer"
    if isinstance(t, (T.DecimalType, T.DoubleType, T.FloatType)):
        return "float"
    kinds = {T.BooleanType: "boolean", T.StringType: "string", T.ArrayType: "array", T.StructType: "object", T.DateType: "date", T.TimestampType: "datetime", T.NullType: "unknown"}
    return next((k for cls, k in kinds.items() if isinstance(t, cls)), "mixed")


def _leaves(t: T.DataType, names: tuple[str, ...] = ()):
    if isinstance(t, T.StructType):
        for f in t:
            yield from _leaves(f.dataType, (*names, f.name))
    else:
        yield names, _kind(t)


def json_paths(df: DataFrame, column: str) -> DataFrame:
    """(path, inferred_type, present): the fields in the JSON texts of a column, with the type that all their values fit.

    Paths join field names by dots; arrays and values of unlike types (`mixed`) end a path. `present`: rows with a value that is not
    null (unknown if a name has quotes of both kinds). Two aggregates over the table: the second counts what the first has found; only the schema comes to the driver. A
    column without one JSON object has no paths.
    """
    values = df.select(parsed(f"`{column}`").alias("v")).where("v IS NOT NULL")
    said = values.agg(F.schema_of_variant_agg("v").alias("s")).first().s
    kind = T.DataType.fromDDL(said.replace("OBJECT<", "STRUCT<"))
    found = [(names, k) for names, k in _leaves(kind) if names]
    if not found:
        return df.sparkSession.createDataFrame([], "path string, inferred_type string, present long")
    cells = []
    for names, k in found:
        present = F.lit(None).cast("long")
        if not any("'" in x and '"' in x for x in names):
            value = F.try_variant_get("v", path_of(*names), "variant")
            present = F.count_if(value.isNotNull() & ~F.is_variant_null(value))
        cells.append(F.struct(F.lit(".".join(names)).alias("path"), F.lit(k).alias("inferred_type"), present.alias("present")))
    return values.agg(F.array(*cells).alias("c")).select(F.explode("c").alias("c")).select("c.*")


def flattened(df: DataFrame, column: str, paths: dict[str, tuple[list[str | int], str]]) -> DataFrame:
    """The table with a column for each path: output name -> (path, type). The text is parsed once a row."""
    rows = df.withColumn("_v", parsed(f"`{column}`"))
    return rows.select(*(f"`{c}`" for c in df.columns), *(value_at("_v", names, kind).alias(out) for out, (names, kind) in paths.items()))
