"""Positional rows to named, typed columns by a partial schema.

A schema is {"name": ..., "fields": {position: {"name", "type", "alias", "python_name", "remote_name",
"transformer", "constraints", ...}}, "total": n}.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import convert

SPARK_TYPES = {
    "integer": T.LongType(), "float": T.DoubleType(), "boolean": T.BooleanType(), "string": T.StringType(),
    "datetime": T.TimestampType(), "date": T.DateType(), "json": T.StringType(), "unknown": T.StringType(),
}
BOOKKEEPING = ("_synced_at", "_sync_version", "_is_partial")


def fields_of(schema: dict) -> dict[int, dict]:
    return {int(k): v for k, v in schema["fields"].items()}


def total_of(schema: dict) -> int:
    return int(schema.get("total") or (max(fields_of(schema), default=-1) + 1))


def output_name(schema: dict, position: int, use_alias: bool = True) -> str:
    """python_name, else alias, else name; a position without a description is Field_<position>."""
    f = fields_of(schema).get(position)
    if f is None:
        return f"Field_{position}"
    return (f.get("python_name") or f.get("alias") or f["name"]) if use_alias else f["name"]


def output_names(schema: dict, use_alias: bool = True) -> list[str]:
    return [output_name(schema, p, use_alias) for p in range(total_of(schema))]


def resolve(schema: dict, key: str | int) -> int:
    """Position of a field given by position or by any of its names."""
    if isinstance(key, int):
        return key
    for p, f in fields_of(schema).items():
        if key in (f["name"], f.get("alias"), f.get("python_name"), f.get("remote_name")):
            return p
    raise KeyError(key)


def struct_of(schema: dict) -> T.StructType:
    """StructType of a schema; what a type can't hold goes to the fields' metadata."""
    out = []
    for p in range(total_of(schema)):
        f = fields_of(schema).get(p, {"type": "unknown"})
        meta = {k: v for k, v in f.items() if k not in ("type", "transformer", "validator")} | {"position": p}
        out.append(T.StructField(output_name(schema, p), SPARK_TYPES[f.get("type", "unknown")], not f.get("constraints", {}).get("not_null", False), meta))
    return T.StructType(out)


def expand_star(df: DataFrame, schema: dict, use_alias: bool = True) -> DataFrame:
    """`*` over positions: every column gets its schema name; columns beyond the schema are Field_n."""
    names = [output_name(schema, p, use_alias) for p in range(len(df.columns))]
    return df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(df.columns, names, strict=True)))


def map_positions(df: DataFrame, schema: dict, rows: str | None = None, width: int | None = None) -> DataFrame:
    """Named columns of positional rows, untyped.

    `rows` names an array column; otherwise the columns stand in order. Positions beyond the schema
    (up to `width`) are Field_n, missing trailing ones null.
    """
    n = width or max(total_of(schema), 0 if rows else len(df.columns))
    if rows:
        cells = [F.try_element_at(F.col(rows), F.lit(p + 1)) for p in range(n)]
    else:
        cells = [F.col(f"`{df.columns[p]}`") if p < len(df.columns) else F.lit(None).cast("string") for p in range(n)]
    return df.select(*(c.alias(output_name(schema, p)) for p, c in enumerate(cells)))


def transform_fields(df: DataFrame, schema: dict, keep_raw: bool = False) -> DataFrame:
    """Each described column converted to its type, or by its transformer.

    A transformer is a type name or a function Column -> Column (a pandas UDF will do). Nulls stay
    null. A value that can't be converted becomes null; with `keep_raw` its text is kept in `<name>__raw`.
    """
    kinds = {output_name(schema, p): f.get("transformer") or f.get("type", "unknown") for p, f in fields_of(schema).items()}
    out: list[Column] = []
    for c in df.columns:
        raw, kind = F.col(f"`{c}`"), kinds.get(c)
        if kind is None:
            out.append(raw)
            continue
        value = convert(raw, kind) if isinstance(kind, str) else F.when(raw.isNotNull(), kind(raw))
        out.append(value.alias(c))
        if keep_raw and isinstance(kind, str) and kind not in ("string", "unknown"):
            out.append(F.when(raw.isNotNull() & value.isNull(), raw.cast("string")).alias(f"{c}__raw"))
    return df.select(*out)


def storage_columns(schema: dict) -> list[str]:
    """Names safe for storage: python_name or name, `-` and blanks as `_`, repeats numbered."""
    seen: dict[str, int] = {}
    out = []
    for p in range(total_of(schema)):
        f = fields_of(schema).get(p)
        name = ((f.get("python_name") or f["name"]) if f else f"Field_{p}").replace("-", "_").replace(" ", "_")
        k = seen.get(name, 0)
        seen[name] = k + 1
        out.append(f"{name}_{k}" if k else name)
    return out


def named_view(df: DataFrame, schema: dict, view: str | None = None) -> DataFrame:
    """Stored columns under their remote names (or names), bookkeeping columns last; optionally a temp view."""
    data = [c for c in df.columns if c not in BOOKKEEPING]
    described = fields_of(schema)
    names = [(described[p].get("remote_name") or described[p]["name"]) if p in described else f"Field_{p}" for p in range(len(data))]
    out = df.select(*(F.col(f"`{c}`").alias(n) for c, n in zip(data, names, strict=True)), *(c for c in BOOKKEEPING if c in df.columns))
    if view:
        out.createOrReplaceTempView(view)
    return out


def load_schemas(spark: SparkSession, path: str) -> dict[str, dict]:
    """Schemas of one JSON (or, where PyYAML is there, YAML) file, or of a folder's `*-schema.*` files, wherever Spark can read."""
    whole = path if path.rsplit(".", 1)[-1] in ("json", "yaml", "yml") else f"{path.rstrip('/')}/*-schema.*"
    files = spark.read.text(whole, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value").orderBy("path").collect()
    out: dict[str, dict] = {}
    for path, text in files:
        if path.endswith(".json"):
            data = json.loads(text)
        else:
            import yaml

            data = yaml.safe_load(text)
        for name, s in data.get("schemas", data).items():
            out[name] = {"name": name, "fields": s["fields"], "total": s.get("total") or s.get("total_fields")}
    return out


def read_with_schema(spark: SparkSession, path: str, schema: dict, kind: str = "parquet", rows: str | None = None, **options) -> DataFrame:
    """A positional table read by its schema: names, types and transformers of every described position.

    `rows` names an array column that holds the positions; otherwise the file's columns stand in order.
    """
    df = spark.read.options(**options).format(kind).load(path)
    return transform_fields(map_positions(df, schema, rows), schema)


def infer_schema(df: DataFrame, overrides: dict[int, str] | None = None, name: str = "table") -> dict:
    """A schema from types and meanings found in the data; `overrides` name positions by hand."""
    from .profile import classify_columns

    fields = {}
    for r in classify_columns(df).orderBy("position").collect():
        fields[r.position] = {"name": (overrides or {}).get(r.position, r.inferred_name), "type": r.inferred_type}
    return {"name": name, "fields": fields, "total": len(df.columns)}
