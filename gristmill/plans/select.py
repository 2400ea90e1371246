"""SELECT, INSERT, UPDATE and DELETE requests given as dicts, built as lazy DataFrames.

Names: in `data`, `group_by` and `order_by` a string is a column (`t.c` or `c`). In comparisons and
functions the first string is a column and the others are literals; in arithmetic all strings are
columns. `{"t": "c"}` is column c of t; `{"col": x}` and `{"lit": x}` say it outright.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import aggregates as A
from ..functions import predicates as P
from ..functions import scalars as S
from ..operators import dml
from ..operators.intervals import range_join

Tables = dict[str, DataFrame]
_COMPARE = {"eq": "eq", "neq": "neq", "gt": "gt", "gte": "gte", "lt": "lt", "lte": "lte", "like": "like", "ilike": "ilike"}
_MATH = {"add": S.add, "sub": S.sub, "mul": S.mul, "mod": S.mod}
_WORDS = {"and", "or", "not", "in", "is", "is_not", "div", "function", "select", "lit", "col", "regexp_replace", "merged", *_COMPARE, *_MATH}
#: Aggregates that add up from those of parts.
_ADDED_UP = ("count", "sum", "min", "max")


def _list(x: Any) -> list:
    return list(x) if isinstance(x, (list, tuple)) else [x]


def column(node: Any, tables: Tables, first: bool = True) -> Column:
    """The Column of a node; a string is a column if it comes `first`, else a literal."""
    if isinstance(node, Column):
        return node
    if isinstance(node, str):
        return F.col(node) if first else F.lit(node)
    if not isinstance(node, dict):
        return F.lit(node)
    kind = next((k for k in node if k in _WORDS), None)
    if kind is None:
        (table, name), *_ = [(k, v) for k, v in node.items() if k != "as"]
        return F.col(f"{table}.{name}")
    value = node[kind]
    if kind in ("lit", "col"):
        return F.lit(value) if kind == "lit" else F.col(value)
    if kind == "merged":
        return value
    if kind == "select":
        return run_select(value, tables).scalar()
    if kind == "function":
        return _function(value.lower(), node.get("args", []), tables)
    if kind == "not":
        return ~column(_list(value)[0], tables)
    if kind in ("and", "or"):
        parts = [column(x, tables) for x in value]
        return P.all_of(*parts) if kind == "and" else P.any_of(*parts)
    if kind == "in":
        return _in(value, tables)
    args = _list(value)
    if kind in ("is", "is_not"):
        return (P.is_value if kind == "is" else P.is_not_value)(column(args[0], tables), args[1])
    if kind in _MATH:
        return _MATH[kind](*(column(x, tables) for x in args))
    if kind == "div":
        return S.div(column(args[0], tables), column(args[1], tables), integers=bool(node.get("integers")))
    if kind == "regexp_replace":
        return S.regexp_replace_first(column(args[0], tables), args[1], args[2])
    left = column(args[0], tables)
    if kind in ("like", "ilike"):
        return P.LOOKUPS[kind](left, args[1])
    return P.LOOKUPS[_COMPARE[kind]](left, column(args[1], tables, first=False))


def _in(value: list, tables: Tables) -> Column:
    """All three shapes: [c, {"select": spec}], [c, [spec or values]], [c, v1, v2, ...]."""
    target, rest = column(value[0], tables), value[1:]
    if len(rest) == 1 and isinstance(rest[0], (list, tuple)):
        rest = rest[0]
    if len(rest) == 1 and isinstance(rest[0], dict):
        return target.isin(run_select(rest[0].get("select", rest[0]), tables))
    return target.isin(list(rest))


def _function(name: str, args: Any, tables: Tables) -> Column:
    args = _list(args)
    inner = args[0] if args else None
    if isinstance(inner, dict) and inner.get("function") == "distinct":
        cs = [column(x, tables) for x in _list(inner["args"])]
        return A.count_distinct(*cs) if name == "count" else A.of_distinct(name, cs[0])
    if name == "count" and args in (["*"], []):
        return A.count_rows()
    if name == "string_agg":
        return A.string_agg(column(inner, tables), args[1])
    if name == "regexp_replace":
        return S.regexp_replace_first(column(inner, tables), args[1], args[2])
    if name == "date":
        return S.to_date(column(inner, tables))
    if name in A.AGGREGATES:
        return A.AGGREGATES[name](column(inner, tables))
    return F.call_function(name, *(column(x, tables, first=i == 0) for i, x in enumerate(args)))


def _is_call(node: Any) -> bool:
    """Whether a node is itself an aggregate call, or what took its place."""
    return isinstance(node, dict) and "select" not in node and ("merged" in node or str(node.get("function", "")).lower() in {*A.AGGREGATES, "string_agg"})


def _calls(node: Any) -> list[dict]:
    """Aggregate calls of an expression."""
    if _is_call(node):
        return [node]
    if isinstance(node, dict):
        return [] if "select" in node else [c for x in node.values() for c in _calls(x)]
    return [c for x in node for c in _calls(x)] if isinstance(node, list) else []


def _is_aggregate(node: Any) -> bool:
    return bool(_calls(node))


def _source(item: Any, tables: Tables) -> DataFrame:
    if isinstance(item, str):
        return tables[item].alias(item)
    inner = item.get("join", item.get("table", item.get("select")))
    alias = item.get("as") or (inner if isinstance(inner, str) else None)
    if isinstance(inner, DataFrame):
        return inner.alias(alias)
    df = tables[inner] if isinstance(inner, str) else run_select(inner.get("select", inner), tables)
    return df.alias(alias) if alias else df


def _from(items: Any, tables: Tables) -> DataFrame:
    items = _list(items)
    first, *joins = items
    df = _source(first, tables)
    for j in joins:
        how = j.get("how", "inner").lower()
        if "on" not in j or how == "cross":
            df = df.crossJoin(_source(j, tables))
            continue
        on = [column(x, tables) for x in j["on"]] if isinstance(j["on"], list) else [column(j["on"], tables)]
        if how == "inner" and (found := _range_of(j["on"], _aliases(items[: items.index(j)]), _aliases([j]))):
            ends, (open_low, open_high), here, others = found
            point, low, high = (column(x, tables) for x in ends)
            sides = (df, _source(j, tables)) if here else (_source(j, tables), df)
            df = range_join(*sides, point, low, high, P.all_of(*(column(x, tables) for x in others)) if others else None, open_low, open_high)
            continue
        df = df.join(_source(j, tables), P.all_of(*on), {"full": "full_outer"}.get(how, how))
    return df


def _columns_of(node: Any, first: bool = True) -> set[tuple[str, str]]:
    """(table, column) that an expression names outside aggregates; the table is "" for a column without one, and for what isn't looked into."""
    if isinstance(node, str):
        return {node.rpartition(".")[::2]} if first else set()
    if isinstance(node, Column):
        return {("", "")}
    if not isinstance(node, dict) or "lit" in node or _is_call(node):
        return set()
    kind = next((k for k in node if k in _WORDS), None)
    if kind is None:
        return {next((k, v) for k, v in node.items() if k != "as")}
    args = _list(node.get("args", []) if kind == "function" else node[kind])
    if kind in _MATH or kind in ("col", "div", "and", "or", "not"):
        return set().union(*map(_columns_of, args))
    if kind in _COMPARE or kind in ("function", "is", "is_not", "regexp_replace") or (kind == "in" and not _in_subquery(node)):
        return set().union(*(_columns_of(x, i == 0) for i, x in enumerate(args)))
    return {("", "")}


def _tables_of(node: Any, first: bool = True) -> set[str]:
    """Tables that an expression names; "" for a column without one."""
    return {t for t, _ in _columns_of(node, first)}


def _range_of(on: Any, left: set[str], right: set[str]) -> tuple[tuple[Any, Any, Any], tuple[bool, bool], bool, list] | None:
    """What a join condition without equality says of a range low <= point <= high, None if it says none.

    ((point, low, high), whether each bound is left out, whether the point is of the left side, the other parts of the condition).
    """
    parts = on["and"] if isinstance(on, dict) and "and" in on else _list(on)
    sides = lambda x, first: ({"left"} if (t := _tables_of(x, first)) and t <= left else {"right"} if t and t <= right else set() if not t else {"both"})
    bounds: dict[tuple[str, bool], Any] = {}
    for k, x in enumerate(parts):
        op = next((o for o in ("eq", "gt", "gte", "lt", "lte") if isinstance(x, dict) and o in x), None)
        if op is None:
            continue
        (a, b), above = x[op], op in ("gt", "gte")
        one, two = sides(a, True), sides(b, False)
        if one | two != {"left", "right"} or one == two:
            continue
        if op == "eq":
            return None
        bounds.setdefault((repr(a), above), (a, b, one == {"left"}, op, k))
        bounds.setdefault((repr(b), not above), (b, a, two == {"left"}, op, k))
    for (name, above), (point, low, here, op, k) in bounds.items():
        if above and (name, False) in bounds:
            _, high, _, other, m = bounds[name, False]
            return (point, low, high), (op in ("gt", "lt"), other in ("gt", "lt")), here, [x for i, x in enumerate(parts) if i not in (k, m)]
    return None


def _aliases(items: Any) -> set[str]:
    """Names by which the tables of a FROM list are known."""
    return {x if isinstance(x, str) else x.get("as") or x.get("join", x.get("table")) for x in _list(items)}


def _merged(node: Any, columns: Iterator[Column]) -> Any:
    """An expression with its aggregate calls replaced, in their order."""
    if _is_call(node):
        return {"merged": next(columns)} | {k: v for k, v in node.items() if k == "as"}
    if isinstance(node, dict):
        return node if "select" in node else {k: _merged(x, columns) for k, x in node.items()}
    return [_merged(x, columns) for x in node] if isinstance(node, list) else node


def _grouped_first(spec: dict, tables: Tables) -> dict:
    """The request, with one side of its range join grouped before the join where its aggregates allow it.

    Counts, sums, least and greatest values of one side's columns need no pairs of rows. That side is grouped by those of
    its columns that stand outside the aggregates (in ON, WHERE, GROUP BY, HAVING), and the join adds its groups up: copies
    of a value meet an interval once. Columns must be named with their table, else the request stays as it is.
    """
    items, data, having = _list(spec["from"]), _list(spec.get("data", "*")), spec.get("having")
    *before, last = items
    calls = _calls([data, having])
    if not calls or not before or not isinstance(last, dict) or "on" not in last or last.get("how", "inner").lower() != "inner" or _range_of(last["on"], _aliases(before), _aliases([last])) is None:
        return spec
    rows = [str(c["function"]).lower() == "count" and _list(c.get("args", [])) in (["*"], []) for c in calls]
    values = [(_list(c.get("args", [])) or [None])[0] for c, every in zip(calls, rows, strict=True) if not every]
    if any(str(c["function"]).lower() not in _ADDED_UP for c in calls) or any(isinstance(x, dict) and x.get("function") == "distinct" for x in values):
        return spec
    by = set().union(*map(_columns_of, _list(spec.get("group_by") or [])))
    plain = by.union(*map(_columns_of, [*_list(last["on"]), spec.get("where"), having, *(x for x in data if _is_aggregate(x))]))
    within = {t for x in values for t in _tables_of(x)}
    if "" in within or any(t == "" for t, _ in plain) or any(_is_aggregate(x) and "as" not in x and not any(x is c for c in calls) for x in data):
        return spec
    sides = [(k, name) for k, item in enumerate(items) if k == len(items) - 1 or len(items) == 2 for name in _aliases([item]) if within <= {name}]
    if not sides:
        return spec
    place, name = min(sides, key=lambda s: sum(t == s[1] for t, _ in by))
    side = _source(items[place], tables)
    own = sorted(c for t, c in plain if t == name)
    if len(set(side.columns)) < len(side.columns) or not set(own) <= set(side.columns):
        return spec
    figures = [column(c, tables) for c in calls]
    named = side.agg(*figures).schema
    grouped = side.groupBy(*(F.col(f"{name}.{c}") for c in own)).agg(*(f.alias(f"_part{i}") for i, f in enumerate(figures)))
    merged = []
    for i, (call, field) in enumerate(zip(calls, named, strict=True)):
        kind = str(call["function"]).lower()
        total = (F.sum if kind == "count" else A.AGGREGATES[kind])(F.col(f"{name}._part{i}"))
        # A sum of sums has the type of a sum; without any rows a count is 0.
        total = F.coalesce(total, F.lit(0)) if kind == "count" else total.cast(field.dataType)
        merged.append(total if "as" in call else total.alias(field.name))
    columns = iter(merged)
    item = ({"on": last["on"], "join": grouped} if place else {"table": grouped}) | {"as": name}
    return spec | {"data": _merged(data, columns), "having": _merged(having, columns), "from": [*items[:place], item, *items[place + 1 :]]}


def _named(node: Any, tables: Tables, known: set[str]) -> list[Column]:
    """Output columns of one entry of `data`; `known` are the table names that can stand before a column."""
    if node == "*":
        return [F.col("*")]
    if isinstance(node, dict) and node.get("function") == "distinct":
        return [column(x, tables) for x in _list(node["args"])]
    if isinstance(node, dict) and not any(k in _WORDS for k in node) and "as" not in node and "." not in str(next(iter(node))):
        # {column: alias} if the key is no table alias; {table: column} otherwise.
        (key, value), *_ = node.items()
        return [F.col(f"{key}.{value}") if key in known else F.col(key).alias(value)]
    c = column(node, tables)
    return [c.alias(node["as"])] if isinstance(node, dict) and "as" in node else [c]


def order_columns(order_by: Any) -> list[Column]:
    """`"c"`, `["a", "b"]`, `["c", "DESC"]` or `[["a", "DESC"], "b"]`; nulls count as greatest."""
    items = _list(order_by)
    if len(items) == 2 and isinstance(items[1], str) and items[1].upper() in ("ASC", "DESC"):
        items = [items]
    out = []
    for x in items:
        name, way = (x[0], x[1].upper()) if isinstance(x, (list, tuple)) else (x, "ASC")
        out.append(F.col(name).desc_nulls_first() if way == "DESC" else F.col(name).asc_nulls_last())
    return out


def default_order(spec: dict) -> list[str]:
    """`id`, when a limited request of one plain table selects it, and says no order, group or aggregate."""
    data = _list(spec.get("data", "*"))
    plain = isinstance(spec.get("from"), str) or (len(_list(spec["from"])) == 1 and "table" in _list(spec["from"])[0])
    limited = spec.get("limit") is not None or spec.get("offset") is not None
    wanted = "*" in data or any(x == "id" or (isinstance(x, str) and x.endswith(".id")) for x in data)
    return ["id"] if limited and plain and wanted and not spec.get("group_by") and not _is_aggregate(data) and not spec.get("order_by") else []


def _in_subquery(node: Any) -> tuple[Any, dict] | None:
    """(column, subquery) of IN with a subquery; none for anything else."""
    if not isinstance(node, dict) or "in" not in node:
        return None
    rest = node["in"][1:]
    if len(rest) == 1 and isinstance(rest[0], (list, tuple)):
        rest = rest[0]
    return (node["in"][0], rest[0].get("select", rest[0])) if len(rest) == 1 and isinstance(rest[0], dict) else None


def _not_in(node: Any) -> tuple[Any, dict] | None:
    """The same of NOT IN."""
    return _in_subquery(_list(node["not"])[0]) if isinstance(node, dict) and "not" in node else None


def _figures(sub: DataFrame) -> Column:
    """Number of rows and of nulls of a subquery's only column, as a struct."""
    return sub.agg(F.struct(F.count("*").alias("n"), F.count_if(F.col(sub.columns[0]).isNull()).alias("nulls")).alias("f")).scalar()


def _marked(df: DataFrame, node: Any, tables: Tables, names: list[str]) -> tuple[DataFrame, Any]:
    """The rows with a mark for each IN subquery below AND, OR and NOT, and the predicate over the marks.

    A mark join: a left join with the subquery's distinct values. The mark is null where SQL says so: nothing
    equal is found, and the value or one of the subquery's rows is null.
    """
    if (found := _in_subquery(node)) is not None:
        name = f"_in{len(names)}"
        names.append(name)
        key, sub = column(found[0], tables), run_select(found[1], tables).toDF(name)
        figures = _figures(sub)
        df = df.join(sub.where(F.col(name).isNotNull()).distinct(), key == F.col(name), "left")
        unknown = key.isNull() | (figures["nulls"] > 0)
        return df, F.when(figures["n"] == 0, False).when(F.col(name).isNotNull(), True).when(unknown, F.lit(None)).otherwise(False)
    for kind in ("and", "or", "not"):
        if isinstance(node, dict) and kind in node:
            parts = []
            for x in _list(node[kind]):
                df, part = _marked(df, x, tables, names)
                parts.append(part)
            return df, {kind: parts}
    return df, node


def _has_subquery(node: Any) -> bool:
    return _in_subquery(node) is not None or isinstance(node, dict) and any(_has_subquery(x) for kind in ("and", "or", "not") if kind in node for x in _list(node[kind]))


def _filtered(df: DataFrame, where: Any, tables: Tables) -> DataFrame:
    """Rows for which the predicate holds.

    Spark plans NOT IN as a join that broadcasts the whole subquery. Here NOT IN, alone or joined by AND, is an
    anti join and a check for nulls on either side; IN and NOT IN deeper in a predicate are mark joins.
    """
    if where is None:
        return df
    parts, names = where["and"] if isinstance(where, dict) and "and" in where else [where], []
    plain = []
    for x in parts:
        if (found := _not_in(x)) is not None:
            key, sub = column(found[0], tables), run_select(found[1], tables).toDF("_in")
            figures = _figures(sub)
            df = df.join(sub, key == F.col("_in"), "left_anti").where((figures["n"] == 0) | (key.isNotNull() & (figures["nulls"] == 0)))
        elif _in_subquery(x) is None and _has_subquery(x):
            df, x = _marked(df, x, tables, names)
            plain.append(x)
        else:
            plain.append(x)
    return df.where(P.all_of(*(column(x, tables) for x in plain))).drop(*names) if plain else df


def run_select(spec: dict, tables: Tables) -> DataFrame:
    """from → where → group and having → data → distinct → order → offset and limit."""
    spec = _grouped_first(spec, tables)
    df = _filtered(_from(spec["from"], tables), spec.get("where"), tables)
    data = _list(spec.get("data", "*"))
    distinct = bool(spec.get("distinct")) or any(isinstance(x, dict) and x.get("function") == "distinct" for x in data)
    keys = _list(spec.get("group_by") or [])
    known = _aliases(spec["from"])
    outputs = [c for x in data for c in _named(x, tables, known)]
    if keys or _is_aggregate(data) or spec.get("having") is not None:
        by = [column(k, tables) for k in keys]
        aggregates = [c for x in data if _is_aggregate(x) for c in _named(x, tables, known)]
        if not aggregates:
            df = df.select(*outputs).distinct()
        else:
            extra = [column(spec["having"], tables).alias("_having")] if spec.get("having") is not None else []
            df = df.groupBy(*by).agg(*aggregates, *extra)
            if extra:
                df = df.where("_having").drop("_having")
            names = iter(df.columns[len(by) :])
            plain = iter(df.columns[: len(by)])
            order = [next(names) if _is_aggregate(x) else None for x in data]
            picked = []
            for x, name in zip(data, order, strict=True):
                if name is not None:
                    picked.append(F.col(f"`{name}`"))
                else:
                    key = next(plain)
                    alias = x.get("as") if isinstance(x, dict) else None
                    picked.append(F.col(f"`{key}`").alias(alias) if alias else F.col(f"`{key}`"))
            df = df.select(*picked)
    else:
        ordered = spec.get("order_by") or default_order(spec)
        names = {x["as"] for x in data if isinstance(x, dict) and "as" in x}
        if ordered and not distinct and not names.intersection(str(c) for c in _list(ordered)):
            df = df.orderBy(*order_columns(ordered))
            spec = spec | {"order_by": None}
        df = df.select(*outputs)
    if distinct:
        df = df.distinct()
    if spec.get("order_by"):
        df = df.orderBy(*order_columns(spec["order_by"]))
    if spec.get("offset"):
        df = df.offset(int(spec["offset"]))
    return df.limit(int(spec["limit"])) if spec.get("limit") is not None else df


def run_insert(spec: dict, tables: Tables) -> tuple[DataFrame, DataFrame]:
    return dml.insert_rows(tables[spec["into"]], spec["columns"], spec["values"], spec.get("returning"))


def run_update(spec: dict, tables: Tables) -> tuple[DataFrame, DataFrame]:
    where = None if spec.get("where") is None else column(spec["where"], tables)
    return dml.update_rows(tables[spec["table"]], {k: column(v, tables, first=False) for k, v in spec["set"].items()}, where, spec.get("returning"))


def run_delete(spec: dict, tables: Tables) -> tuple[DataFrame, DataFrame]:
    where = None if spec.get("where") is None else column(spec["where"], tables)
    return dml.delete_rows(tables[spec["from"]], where, spec.get("returning"))


def query_sql(tables: Tables, sql: str, args: dict | list | None = None) -> DataFrame:
    """SQL text over the given tables, with bound parameters if any.

    The tables are common table expressions of this one statement: nothing is registered under their names,
    so calls at the same time don't see each other's rows, and a later call knows only its own tables. The text is a
    query; a WITH of its own follows the tables. A table may also stand in braces; other braces stay as they are.
    """
    spark = next(iter(tables.values())).sparkSession
    given = {f"t{i}": df for i, df in enumerate(tables.values())}
    quoted = {name: f"`{name.replace('`', '``')}`" for name in tables}
    text = re.sub(r"\{(\w+)\}", lambda m: quoted.get(m[1], m[0]), sql).replace("{", "{{").replace("}", "}}")
    named = ", ".join(f"{name} AS (SELECT * FROM {{t{i}}})" for i, name in enumerate(quoted.values()))
    own = re.match(r"(?:\s|--[^\n]*\n|/\*.*?\*/)*WITH\s+(RECURSIVE\s+)?", text, re.I | re.S)
    text = f"WITH {own[1] or ''}{named}, {text[own.end():]}" if own else f"WITH {named} {text}"
    return spark.sql(text, args or None, **given)
