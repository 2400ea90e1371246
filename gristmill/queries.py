"""Registered queries of the relational operators, each with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions import aggregates as A
from .functions import predicates as P
from .functions import scalars as S
from .operators import checks, dml, documents, intervals, mapping, merge, profile, relational
from .plans.select import query_sql, run_delete, run_insert, run_select, run_update
from .sources import export, ordered, sketches, state
from .streaming.incremental import stream_into

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Source(dict):
    """Tables of one folder, read when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        self[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self[name]


def query(sql: str | None):
    """Register a function of the tables under its name, with its SQL."""

    def register(f: Callable[[Source], DataFrame]):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Source(spark, sf_dir))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return register


def request(name: str, spec: dict, sql: str) -> None:
    """Register a SELECT request."""

    def f(t: Source) -> DataFrame:
        return run_select(spec, t)

    f.__name__ = name
    query(sql)(f)


# --- projections and scalar functions ---------------------------------------------------------------

request(
    "project_alias",
    {"data": [{"l_orderkey": "k"}, "l_linenumber", {"mul": ["l_extendedprice", {"sub": [{"lit": 1}, "l_discount"]}], "as": "net"}, {"add": ["l_quantity", {"lit": 1}, "l_tax"], "as": "more"}, {"lit": "x", "as": "tag"}], "from": "lineitem"},
    "SELECT l_orderkey AS k, l_linenumber, l_extendedprice * (1 - l_discount) AS net, l_quantity + 1 + l_tax AS more, 'x' AS tag FROM lineitem",
)
request(
    "int_div_mod",
    {"data": ["o_orderkey", {"div": ["o_orderkey", {"lit": 7}], "integers": True, "as": "d"}, {"mod": [{"sub": [{"lit": 3}, "o_orderkey"]}, {"lit": 5}], "as": "m"}], "from": "orders"},
    "SELECT o_orderkey, o_orderkey // 7 AS d, (3 - o_orderkey) % 5 AS m FROM orders",
)
request("star_expand", {"data": ["*"], "from": "nation"}, "SELECT * FROM nation")


@query("SELECT n_nationkey AS id, n_name AS nation, n_regionkey AS Field_2 FROM nation")
def expand_star(t):
    schema = {"name": "nation", "fields": {0: {"name": "id", "type": "integer"}, 1: {"name": "name", "alias": "nation"}}, "total": 2}
    return mapping.expand_star(t["nation"].select("n_nationkey", "n_name", "n_regionkey"), schema)


request("distinct_rows", {"data": ["c_nationkey", "c_mktsegment"], "from": "customer", "distinct": True}, "SELECT DISTINCT c_nationkey, c_mktsegment FROM customer")
request("distinct_function", {"data": [{"function": "distinct", "args": ["o_orderstatus", "o_orderpriority"]}], "from": "orders"}, "SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
request(
    "scalar_subquery",
    {"data": ["n_nationkey", {"select": {"data": [{"function": "max", "args": "c_acctbal", "as": "m"}], "from": "customer"}, "as": "most"}], "from": "nation"},
    "SELECT n_nationkey, (SELECT max(c_acctbal) FROM customer) AS most FROM nation",
)
request(
    "regexp_first",
    {"data": ["p_partkey", {"function": "regexp_replace", "args": ["p_name", "([aeiou])(.)", "<\\2\\1>"], "as": "cleared"}], "from": "part"},
    r"SELECT p_partkey, regexp_replace(p_name, '([aeiou])(.)', '<\2\1>') AS cleared FROM part",
)
request("date_fn", {"data": ["o_orderkey", {"function": "date", "args": "o_orderdate", "as": "d"}], "from": "orders"}, "SELECT o_orderkey, o_orderdate::DATE AS d FROM orders")
request(
    "nested_functions",
    {"data": [{"function": "sum", "args": [{"function": "length", "args": [{"function": "upper", "args": "c_name"}]}], "as": "n"}, {"function": "max", "args": [{"function": "abs", "args": "c_acctbal"}], "as": "m"}], "from": "customer"},
    "SELECT sum(length(upper(c_name)))::BIGINT AS n, max(abs(c_acctbal)) AS m FROM customer",
)


@query("SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k, try_cast(event_type AS BIGINT) AS bad, value::VARCHAR IS NOT NULL AS has_value, trim('  ' || event_type || ' ') AS name FROM events")
def casts(t):
    k = S.convert(F.get_json_object("props", "$.k"), "integer")
    return t["events"].select("event_id", k.alias("k"), S.convert("event_type", "integer").alias("bad"), S.not_blank(F.col("value").cast("string")).alias("has_value"), S.trimmed(F.concat(F.lit("  "), "event_type", F.lit(" "))).alias("name"))


# --- filters ----------------------------------------------------------------------------------------

request(
    "filter_cmp",
    {"data": ["l_orderkey", "l_linenumber"], "from": "lineitem", "where": {"and": [{"gte": ["l_quantity", 10]}, {"lt": ["l_quantity", 24]}, {"gt": ["l_discount", 0.02]}, {"lte": ["l_tax", 0.06]}, {"neq": ["l_returnflag", "R"]}, {"eq": ["l_linestatus", "F"]}]}},
    "SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 10 AND l_quantity < 24 AND l_discount > 0.02 AND l_tax <= 0.06 AND l_returnflag <> 'R' AND l_linestatus = 'F'",
)
request(
    "filter_bool",
    {"data": ["o_orderkey"], "from": "orders", "where": {"or": [{"and": [{"eq": ["o_orderstatus", "F"]}, {"not": [{"eq": ["o_orderpriority", "5-LOW"]}]}]}, {"not": {"lt": ["o_totalprice", 300000]}}]}},
    "SELECT o_orderkey FROM orders WHERE (o_orderstatus = 'F' AND NOT o_orderpriority = '5-LOW') OR NOT o_totalprice < 300000",
)


@query("SELECT doc_id, quality IS NULL AS no_label, (quality = 1) IS TRUE AS good, (quality = 1) IS NOT TRUE AS not_good, (toxic = 1) IS FALSE AS clean FROM documents LEFT JOIN labels USING (doc_id)")
def is_null_bool(t):
    rows = t["documents"].select("doc_id").join(t["labels"], "doc_id", "left")
    good = F.col("quality") == 1
    return rows.select("doc_id", P.is_value("quality", None).alias("no_label"), P.is_value(good, True).alias("good"), P.is_not_value(good, True).alias("not_good"), P.is_value(F.col("toxic") == 1, False).alias("clean"))


request(
    "like_ilike",
    {"data": ["p_partkey"], "from": "part", "where": {"or": [{"like": ["p_name", "%ring%"]}, {"ilike": ["p_type", "eco%"]}]}},
    "SELECT p_partkey FROM part WHERE p_name LIKE '%ring%' OR p_type ILIKE 'eco%'",
)


@query("SELECT c_custkey FROM customer WHERE c_mktsegment ILIKE '%auto%' OR c_name ILIKE 'customer#00000001%'")
def contains_prefix(t):
    return t["customer"].where(P.contains_text("c_mktsegment", "auto") | P.starts_with_text("c_name", "customer#00000001")).select("c_custkey")


request("in_list", {"data": ["c_custkey"], "from": "customer", "where": {"and": [{"in": ["c_nationkey", 1, 2, 3]}, {"not": {"in": ["c_mktsegment", ["BUILDING", "MACHINERY"]]}}]}}, "SELECT c_custkey FROM customer WHERE c_nationkey IN (1, 2, 3) AND c_mktsegment NOT IN ('BUILDING', 'MACHINERY')")
_BIG = {"data": "o_custkey", "from": "orders", "where": {"gt": ["o_totalprice", 250000]}}
request("in_subquery", {"data": ["c_custkey"], "from": "customer", "where": {"in": ["c_custkey", {"select": _BIG}]}}, "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")
request("not_in_subquery", {"data": ["c_custkey"], "from": "customer", "where": {"not": {"in": ["c_custkey", [_BIG]]}}}, "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000)")


_STATUS = {"function": "nullif", "args": ["o_orderstatus", {"lit": "P"}], "as": "s"}
request(
    "not_in_or",
    {"data": ["o_orderkey"], "from": "orders", "where": {"or": [{"gt": ["o_totalprice", 300000]}, {"not": {"in": [{k: v for k, v in _STATUS.items() if k != "as"}, {"select": {"data": ["o_orderstatus"], "from": "orders", "where": {"eq": ["o_orderstatus", "O"]}}}]}}]}},
    "SELECT o_orderkey FROM orders WHERE o_totalprice > 300000 OR nullif(o_orderstatus, 'P') NOT IN (SELECT o_orderstatus FROM orders WHERE o_orderstatus = 'O')",
)
request(
    "not_in_or_nulls",
    {"data": ["c_custkey"], "from": "customer", "where": {"or": [{"in": ["c_custkey", {"select": _BIG}]}, {"not": {"or": [{"gt": ["c_acctbal", 500]}, {"in": ["c_mktsegment", {"select": {"data": [{**_STATUS}], "from": "orders"}}]}]}}]}},
    "SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000) OR NOT (c_acctbal > 500 OR c_mktsegment IN (SELECT nullif(o_orderstatus, 'P') FROM orders))",
)


@query("SELECT c_custkey FROM customer WHERE (c_acctbal >= 1000 AND c_nationkey IN (1, 5, 9)) OR NOT (c_acctbal >= -500 AND c_mktsegment LIKE '%')")
def lookup_filter(t):
    return t["customer"].where(P.lookup_filter(c_acctbal__gte=1000, c_nationkey__in=[1, 5, 9]) | ~P.lookup_filter(c_acctbal__gte=-500, c_mktsegment__like="%")).select("c_custkey")


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS NULL AND NOT o_totalprice < 50000 AND o_orderpriority <> '5-LOW'")
def flag_filter(t):
    rows = t["orders"].withColumns({"deleted_at": F.nullif("o_orderstatus", F.lit("O")), "disabled": F.col("o_totalprice") < 50000, "active": F.col("o_orderpriority") != "5-LOW"})
    return rows.where(P.live_rows(rows)).select("o_orderkey")


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice BETWEEN 1000 AND 60000 AND o_orderstatus = 'F'")
def where_text(t):
    return P.where_sql(t["orders"], "o_totalprice BETWEEN 1000 AND 60000 AND o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


request(
    "having",
    {"data": ["o_custkey", {"function": "count", "args": ["*"], "as": "n"}], "from": "orders", "group_by": "o_custkey", "having": {"gt": [{"function": "count", "args": ["*"]}, 12]}},
    "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey HAVING count(*) > 12",
)

# --- joins ------------------------------------------------------------------------------------------


def _join(how: str, on: dict | None) -> dict:
    step = {"join": "nation", "as": "n", "how": how} | ({"on": on} if on else {})
    return {"data": [{"r": "r_name"}, {"n": "n_name"}], "from": [{"table": "region", "as": "r"}, step]}


_ON = {"and": [{"eq": [{"r": "r_regionkey"}, {"n": "n_regionkey"}]}, {"gt": [{"n": "n_nationkey"}, 9]}]}
for _how in ("inner", "left", "right", "full"):
    request(f"join_{_how}", _join(_how, _ON), f"SELECT r.r_name, n.n_name FROM region r {_how.upper()} JOIN nation n ON r.r_regionkey = n.n_regionkey AND n.n_nationkey > 9")
request("join_cross", _join("cross", None), "SELECT r.r_name, n.n_name FROM region r CROSS JOIN nation n")
request(
    "join_chain",
    {
        "data": ["r.r_name", {"function": "count", "args": ["*"], "as": "n"}, {"function": "max", "args": "l.l_quantity", "as": "most"}],
        "from": [
            {"table": "region", "as": "r"},
            {"join": "nation", "as": "n", "on": {"eq": [{"r": "r_regionkey"}, {"n": "n_regionkey"}]}},
            {"join": "customer", "as": "c", "on": {"eq": [{"n": "n_nationkey"}, {"c": "c_nationkey"}]}},
            {"join": "orders", "as": "o", "on": {"eq": [{"c": "c_custkey"}, {"o": "o_custkey"}]}},
            {"join": "lineitem", "as": "l", "on": {"eq": [{"o": "o_orderkey"}, {"l": "l_orderkey"}]}},
        ],
        "group_by": ["r.r_name"],
    },
    "SELECT r_name, count(*) AS n, max(l_quantity) AS most FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON n_nationkey = c_nationkey JOIN orders ON c_custkey = o_custkey JOIN lineitem ON o_orderkey = l_orderkey GROUP BY r_name",
)
request(
    "join_theta",
    {"data": ["s.s_suppkey", "n.n_nationkey"], "from": [{"table": "supplier", "as": "s"}, {"join": "nation", "as": "n", "on": {"and": [{"gte": [{"s": "s_nationkey"}, {"n": "n_nationkey"}]}, {"lt": [{"sub": [{"s": "s_nationkey"}, {"n": "n_nationkey"}]}, {"lit": 3}]}, {"neq": [{"n": "n_regionkey"}, 2]}]}}]},
    "SELECT s.s_suppkey, n.n_nationkey FROM supplier s JOIN nation n ON s.s_nationkey >= n.n_nationkey AND s.s_nationkey - n.n_nationkey < 3 AND n.n_regionkey <> 2",
)
_DEAR = {"data": ["o_orderkey", "o_orderdate"], "from": "orders", "where": {"gt": ["o_totalprice", 250000]}}
request(
    "join_band",
    {
        "data": ["o.o_orderkey", {"function": "count", "args": ["*"], "as": "n"}, {"function": "sum", "args": ["l.l_orderkey"], "as": "keys"}],
        "from": [{"table": {"select": _DEAR}, "as": "o"}, {"join": "lineitem", "as": "l", "on": {"and": [{"gte": [{"l": "l_shipdate"}, {"o": "o_orderdate"}]}, {"lt": [{"l": "l_shipdate"}, {"add": [{"o": "o_orderdate"}, {"lit": timedelta(days=3)}]}]}]}}],
        "group_by": ["o.o_orderkey"],
    },
    "SELECT o_orderkey, count(*) AS n, sum(l_orderkey)::BIGINT AS keys FROM orders JOIN lineitem ON l_shipdate >= o_orderdate AND l_shipdate < o_orderdate + INTERVAL 3 DAY WHERE o_totalprice > 250000 GROUP BY o_orderkey",
)


@query(
    "WITH b AS (SELECT o_custkey, min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders GROUP BY o_custkey HAVING count(*) < 6) "
    "SELECT o_custkey, count(*) AS n FROM b JOIN (SELECT DISTINCT l_shipdate FROM lineitem) ON l_shipdate BETWEEN first AND last GROUP BY o_custkey"
)
def join_range(t):
    """Spans of very unlike lengths, from the first to the last order of a customer, and the days on which something was shipped."""
    spans = t["orders"].groupBy("o_custkey").agg(F.min("o_orderdate").alias("first"), F.max("o_orderdate").alias("last"), F.count("*").alias("n")).where("n < 6").drop("n")
    joined = intervals.range_join(t["lineitem"].select("l_shipdate").distinct(), spans, F.col("l_shipdate"), F.col("first"), F.col("last"))
    return joined.groupBy("o_custkey").agg(F.count("*").alias("n"))


_TOTALS = {"data": ["o_custkey", {"function": "sum", "args": "o_orderkey", "as": "keys"}], "from": "orders", "group_by": "o_custkey"}
request(
    "join_subquery",
    {"data": ["c.c_name", "q.keys"], "from": [{"table": "customer", "as": "c"}, {"join": {"select": _TOTALS}, "as": "q", "how": "left", "on": {"eq": [{"c": "c_custkey"}, {"q": "o_custkey"}]}}]},
    "SELECT c.c_name, q.keys FROM customer c LEFT JOIN (SELECT o_custkey, sum(o_orderkey)::BIGINT AS keys FROM orders GROUP BY o_custkey) q ON c.c_custkey = q.o_custkey",
)
request("from_subquery", {"data": [{"function": "max", "args": "q.keys", "as": "most"}], "from": [{"select": _TOTALS, "as": "q"}]}, "SELECT max(keys)::BIGINT AS most FROM (SELECT sum(o_orderkey) AS keys FROM orders GROUP BY o_custkey)")


@query("SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_totalprice > 250000)")
def anti_join(t):
    return relational.without_match(t["customer"], t["orders"].where("o_totalprice > 250000"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')")
def semi_join(t):
    return relational.with_match(t["customer"], t["orders"].where("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey")).select("c_custkey")


@query("SELECT n_nationkey, r_name, (SELECT coalesce(string_agg(c_custkey::VARCHAR, ',' ORDER BY c_custkey), '') FROM customer WHERE c_nationkey = n_nationkey) AS customers FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def related_children(t):
    up = relational.join_related(t["nation"], t["region"], "n_regionkey", "r_regionkey", "region")
    down = relational.join_related(up, t["customer"].select("c_custkey", "c_nationkey"), "n_nationkey", "c_nationkey", "customers", many=True)
    ids = F.array_join(F.transform("customers", lambda c: c["c_custkey"].cast("string")), ",")
    return down.select("n_nationkey", F.col("region.r_name").alias("r_name"), F.coalesce(ids, F.lit("")).alias("customers"))


@query("SELECT o_orderkey, c_name, c_mktsegment FROM orders LEFT JOIN customer ON o_custkey = c_custkey")
def declared_relation(t):
    schema = {"name": "orders", "fields": {0: {"name": "o_orderkey"}, 1: {"name": "o_custkey", "foreign_key": "customer.c_custkey"}}}
    joined = relational.join_declared(t["orders"].select("o_orderkey", "o_custkey"), schema, {"customer": t["customer"]})
    return joined.select("o_orderkey", "customer.c_name", "customer.c_mktsegment")


# --- aggregates -------------------------------------------------------------------------------------


@query("SELECT count(*) AS n, count(quality) AS n_quality, count(DISTINCT quality) AS kinds, count(DISTINCT (quality, toxic)) AS pairs FROM documents LEFT JOIN labels USING (doc_id)")
def count_kinds(t):
    rows = t["documents"].select("doc_id").join(t["labels"], "doc_id", "left")
    return rows.agg(A.count_rows().alias("n"), F.count("quality").alias("n_quality"), A.count_distinct("quality").alias("kinds"), A.count_distinct("quality", "toxic").alias("pairs"))


request(
    "count_star_and_distinct",
    {"data": [{"function": "count", "args": ["*"], "as": "cnt"}, {"function": "count", "args": {"function": "distinct", "args": "o_custkey"}, "as": "uniq"}, {"function": "count", "args": {"function": "distinct", "args": ["o_orderstatus", "o_orderpriority"]}, "as": "pairs"}], "from": "orders"},
    "SELECT count(*) AS cnt, count(DISTINCT o_custkey) AS uniq, count(DISTINCT (o_orderstatus, o_orderpriority)) AS pairs FROM orders",
)
request(
    "sum_avg_min_max",
    {"data": ["l_returnflag", {"function": "sum", "args": "l_orderkey", "as": "s"}, {"function": "avg", "args": "l_linenumber", "as": "a"}, {"function": "min", "args": "l_extendedprice", "as": "lo"}, {"function": "max", "args": "l_extendedprice", "as": "hi"}], "from": "lineitem", "group_by": ["l_returnflag"]},
    "SELECT l_returnflag, sum(l_orderkey)::BIGINT AS s, avg(l_linenumber) AS a, min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM lineitem GROUP BY l_returnflag",
)
request(
    "agg_distinct",
    {"data": [{"function": f, "args": {"function": "distinct", "args": "l_partkey"}, "as": f"{f}_d"} for f in ("sum", "avg", "min", "max")], "from": "lineitem"},
    "SELECT sum(DISTINCT l_partkey)::BIGINT AS sum_d, avg(DISTINCT l_partkey) AS avg_d, min(DISTINCT l_partkey) AS min_d, max(DISTINCT l_partkey) AS max_d FROM lineitem",
)


@query("SELECT event_type, round(stddev_samp(value), 6) AS sd, round(var_samp(value), 6) AS var FROM events GROUP BY event_type")
def stats(t):
    return t["events"].groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("sd"), F.round(F.var_samp("value"), 6).alias("var"))


@query("SELECT o_orderpriority, bool_and(o_totalprice > 1000) AS all_big, bool_or(o_totalprice > 400000) AS some_big, bool_and(o_orderstatus IN ('F', 'O', 'P')) AS every_known FROM orders GROUP BY o_orderpriority")
def bool_aggs(t):
    return t["orders"].groupBy("o_orderpriority").agg(F.bool_and(F.col("o_totalprice") > 1000).alias("all_big"), F.bool_or(F.col("o_totalprice") > 400000).alias("some_big"), F.every(F.col("o_orderstatus").isin("F", "O", "P")).alias("every_known"))


@query("SELECT n_regionkey, string_agg(n_name, ';' ORDER BY n_name) AS names, '[' || string_agg(n_nationkey::VARCHAR, ',' ORDER BY n_nationkey) || ']' AS keys_json FROM nation GROUP BY n_regionkey")
def list_aggs(t):
    return t["nation"].groupBy("n_regionkey").agg(A.string_agg("n_name", ";").alias("names"), A.json_agg("n_nationkey").alias("keys_json"))


request(
    "group_many",
    {"data": ["l_returnflag", "l_linestatus", {"function": "count", "args": ["*"], "as": "n"}], "from": "lineitem", "group_by": ["l_returnflag", "l_linestatus"]},
    "SELECT l_returnflag, l_linestatus, count(*) AS n FROM lineitem GROUP BY ALL",
)
request("group_keys_only", {"data": ["p_brand"], "from": "part", "group_by": ["p_brand"]}, "SELECT p_brand FROM part GROUP BY p_brand")
request(
    "agg_over_join",
    {
        "data": ["c.c_custkey", "c.c_name", {"function": "count", "args": ["o.o_orderkey"], "as": "order_count"}],
        "from": [{"table": "customer", "as": "c"}, {"join": "orders", "as": "o", "on": {"eq": [{"c": "c_custkey"}, {"o": "o_custkey"}]}}],
        "where": {"gt": [{"o": "o_totalprice"}, 50000]}, "group_by": ["c.c_custkey", "c.c_name"], "order_by": ["order_count", "DESC"],
    },
    "SELECT c_custkey, c_name, count(o_orderkey) AS order_count FROM customer JOIN orders ON c_custkey = o_custkey WHERE o_totalprice > 50000 GROUP BY ALL",
)

# --- order, limit, pages -------------------------------------------------------------------------------


@query("SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) ORDER BY quality DESC NULLS FIRST, doc_id LIMIT 500")
def order_nulls(t):
    rows = t["documents"].select("doc_id").join(t["labels"], "doc_id", "left").select("doc_id", "quality")
    return run_select({"data": ["doc_id", "quality"], "from": "d", "order_by": [["quality", "DESC"], "doc_id"], "limit": 500}, {"d": rows})


request("limit_offset", {"data": ["o_orderkey"], "from": "orders", "order_by": "o_orderkey", "limit": 100, "offset": 250}, "SELECT o_orderkey FROM orders ORDER BY o_orderkey LIMIT 100 OFFSET 250")
request("topk", {"data": ["o_orderkey", "o_totalprice"], "from": "orders", "order_by": [["o_totalprice", "DESC"], "o_orderkey"], "limit": 20}, "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20")


@query("SELECT o_orderkey AS id, o_custkey FROM orders ORDER BY id LIMIT 50")
def default_order(t):
    return run_select({"data": ["id", "o_custkey"], "from": "o", "limit": 50}, {"o": t["orders"].withColumnRenamed("o_orderkey", "id")})


@query("SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 300 OFFSET 600")
def page_offset(t):
    return relational.page(t["orders"].select("o_orderkey", "o_custkey"), ["o_orderkey"], 600, 300)


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber LIMIT 1000 OFFSET (SELECT count(*) // 2 FROM lineitem)")
def page_deep_offset(t):
    rows, path = t["lineitem"].select("l_orderkey", "l_linenumber", "l_shipdate"), state.shared_folder(t.spark, "ordered")
    ordered.write_ordered(rows, ["l_shipdate", "l_orderkey", "l_linenumber"], path)
    return ordered.read_page(t.spark, path, rows.count() // 2, 1000)


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey > 777 ORDER BY o_orderkey LIMIT 300")
def keyset_page(t):
    return relational.keyset_page(t["orders"].select("o_orderkey", "o_custkey"), "o_orderkey", 777, 300)


@query("SELECT event_id, user_id FROM events WHERE event_id > 1000")
def scan_since(t):
    return relational.scan_since(t["events"].select("event_id", "user_id"), "event_id", 1000)


@query("SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F'")
def count_where(t):
    return relational.count_where(t["orders"], F.col("o_orderstatus") == "F")


@query("SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1234.5 GROUP BY ALL")
def sql_text(t):
    return query_sql({"o": t["orders"]}, "SELECT o_orderstatus, count(*) AS n FROM o WHERE o_totalprice > :least GROUP BY ALL", {"least": 1234.5})


@query("WITH big AS (SELECT o_custkey FROM orders WHERE o_totalprice > 250000) SELECT c_mktsegment, count(*) AS n, '{' || min(c_name) || '}' AS least FROM customer JOIN big ON c_custkey = o_custkey GROUP BY c_mktsegment")
def sql_text_plain(t):
    """Without parameters, with a WITH of its own and braces in a text."""
    text = "WITH big AS (SELECT o_custkey FROM orders WHERE o_totalprice > 250000) SELECT c_mktsegment, count(*) AS n, '{' || min(c_name) || '}' AS least FROM customer JOIN big ON c_custkey = o_custkey GROUP BY c_mktsegment"
    return query_sql({"customer": t["customer"], "orders": t["orders"]}, text)


# --- row modification -----------------------------------------------------------------------------------


@query("SELECT * FROM nation UNION ALL VALUES (100, 'NEW_A', NULL), (101, 'NEW_B', NULL)")
def insert_returning(t):
    return run_insert({"into": "n", "columns": ["n_nationkey", "n_name"], "values": [[100, "NEW_A"], [101, "NEW_B"]], "returning": "n_nationkey"}, {"n": t["nation"]})[0]


@query("SELECT c_custkey, CASE WHEN c_acctbal < 0 THEN 'DEBT' ELSE c_mktsegment END AS c_mktsegment, CASE WHEN c_acctbal < 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal FROM customer")
def update_case(t):
    new, _ = run_update({"table": "c", "set": {"c_mktsegment": "DEBT", "c_acctbal": {"mul": ["c_acctbal", {"lit": 2}]}}, "where": {"lt": ["c_acctbal", 0]}}, {"c": t["customer"]})
    return new.select("c_custkey", "c_mktsegment", "c_acctbal")


@query("SELECT c_custkey, c_acctbal FROM customer WHERE c_nationkey < 5")
def update_returning(t):
    return dml.update_rows(t["customer"], {"c_name": "x"}, F.col("c_nationkey") < 5, ["c_custkey", "c_acctbal"])[1]


@query("SELECT c_custkey, CASE WHEN c_acctbal > 0 THEN 'in credit' END AS c_name, c_acctbal * 2 AS c_acctbal FROM customer WHERE c_nationkey < 5")
def update_after_image(t):
    """The columns returned are those that changed: names by a case without ELSE, a balance from its old value."""
    changes = {"c_name": F.when(F.col("c_acctbal") > 0, "in credit"), "c_acctbal": F.col("c_acctbal") * 2}
    return dml.update_rows(t["customer"], changes, F.col("c_nationkey") < 5, ["c_custkey", "c_name", "c_acctbal"])[1]


@query("SELECT * FROM customer WHERE NOT (c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 250000))")
def delete_where(t):
    return run_delete({"from": "c", "where": {"in": ["c_custkey", {"select": _BIG}]}}, {"c": t["customer"], "orders": t["orders"]})[0]


@query("SELECT count(*) AS removed FROM orders")
def truncate(t):
    return dml.truncate(t["orders"])[1]


# --- positional mapping -----------------------------------------------------------------------------------

_LINE = {
    "name": "line", "total": 6,
    "fields": {
        0: {"name": "id", "type": "integer", "alias": "order_id"}, 2: {"name": "supplier key", "type": "integer", "python_name": "supplier"},
        4: {"name": "quantity", "type": "float", "remote_name": "qty"}, 5: {"name": "price", "type": "float"},
    },
}


def _positional(t) -> DataFrame:
    names = ("l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag")
    return t["lineitem"].select(F.array(*(F.col(c).cast("string") for c in names)).alias("cells"))


@query("SELECT l_orderkey::VARCHAR AS order_id, l_partkey::VARCHAR AS \"Field_1\", l_suppkey::VARCHAR AS supplier, l_linenumber::VARCHAR AS \"Field_3\", CAST(l_quantity AS VARCHAR) AS quantity, l_returnflag AS \"Field_6\", NULL::VARCHAR AS \"Field_7\" FROM lineitem")
def map_positions(t):
    return mapping.map_positions(_positional(t), _LINE, rows="cells", width=8).drop("price")


@query("SELECT l_orderkey AS order_id, l_suppkey AS supplier, l_quantity AS quantity, l_extendedprice AS price, NULL::BIGINT AS flag_number, l_returnflag AS flag_number__raw FROM lineitem")
def transform_fields(t):
    schema = _LINE | {"total": 7, "fields": _LINE["fields"] | {6: {"name": "flag_number", "type": "integer"}}}
    typed = mapping.transform_fields(mapping.map_positions(_positional(t), schema, rows="cells"), schema, keep_raw=True)
    return typed.select("order_id", "supplier", "quantity", "price", "flag_number", "flag_number__raw")


@query("SELECT n_nationkey AS id, n_name AS \"Field_1\", n_regionkey AS region, 1::BIGINT AS _sync_version FROM nation")
def named_view(t):
    schema = {"name": "n", "fields": {0: {"name": "id", "type": "integer"}, 2: {"name": "r", "remote_name": "region", "type": "integer"}}, "total": 3}
    return mapping.named_view(merge.stamp(t["nation"]), schema).drop("_synced_at", "_is_partial")


@query("SELECT upper(n_name) AS n_name, n_nationkey * 10 AS n_nationkey FROM nation")
def user_transformers(t):
    schema = {"name": "nation", "fields": {0: {"name": "n_name", "transformer": F.upper}, 1: {"name": "n_nationkey", "transformer": lambda c: c * 10}}}
    return mapping.transform_fields(t["nation"].select("n_name", "n_nationkey"), schema)


@query("SELECT event_id, ts AS at, CAST(ts AS DATE) AS day FROM events")
def iso_values(t):
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return t["events"].select("event_id", S.convert(text, "datetime").cast(t["events"].schema["ts"].dataType).alias("at"), S.convert(text, "date").alias("day"))


@query("SELECT event_id, CASE WHEN event_id % 3 > 0 THEN props END AS props FROM events")
def json_values(t):
    broken = F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("{"), "props")).otherwise(F.col("props"))
    return t["events"].select("event_id", S.convert(broken, "json").alias("props"))


_NESTED_SQL = """WITH j AS (SELECT event_id, json_object('who', json_object('id', user_id, 'name', CASE WHEN user_id % 5 > 0 THEN event_type END), 'p', props::JSON, 'at', json_array(event_id, event_id + 1), 'v', value) AS j FROM events)
SELECT event_id, CAST(j->>'$.who.id' AS BIGINT) AS who, j->>'$.who.name' AS name, CAST(j->>'$.p.k' AS BIGINT) AS k, CAST(j->>'$.at[1]' AS BIGINT) AS second, CAST(j->>'$.v' AS DOUBLE) AS v, CAST(NULL AS BIGINT) AS none FROM j"""


def _nested(t) -> DataFrame:
    """Events as JSON texts, the stored properties inside as they are; one in seven is cut short and so no JSON."""
    e = t["events"]
    name = F.when(F.col("user_id") % 5 > 0, F.concat(F.lit('"'), "event_type", F.lit('"'))).otherwise("null")
    return e.select("event_id", F.concat(F.lit('{"who": {"id": '), "user_id", F.lit(', "name": '), name, F.lit('}, "p": '), "props", F.lit(', "at": ['), "event_id", F.lit(", "), F.col("event_id") + 1, F.lit('], "v": '), F.col("value").cast("string"), F.lit("}")).alias("j"))


@query(_NESTED_SQL)
def json_nested(t):
    """Values at nested paths of parsed JSON; one of the wrong type is null."""
    paths = {"who": (["who", "id"], "integer"), "name": (["who", "name"], "string"), "k": (["p", "k"], "integer"), "second": (["at", 1], "integer"), "v": (["v"], "float"), "none": (["who"], "integer")}
    return documents.flattened(_nested(t), "j", paths).drop("j")


@query(
    "SELECT * FROM (SELECT unnest(['who.id', 'who.name', 'p.k', 'at', 'v']) AS path, unnest(['integer', 'string', 'integer', 'array', 'float']) AS inferred_type, "
    "unnest([count(user_id), count(*) FILTER (user_id % 5 > 0), count(json_extract(props, '$.k')), count(*), count(value)]) AS present FROM events WHERE event_id % 7 > 0)"
)
def json_types(t):
    """The paths in JSON texts with their types; texts that are cut short don't count."""
    whole = F.col("event_id") % 7 > 0
    return documents.json_paths(_nested(t).select(F.when(whole, F.col("j")).otherwise(F.substr("j", F.lit(1), F.length("j") - 1)).alias("j")), "j")


@query("SELECT o_orderkey AS id, o_orderstatus AS Field_1, o_totalprice AS price, 1::BIGINT AS _sync_version, false AS _is_partial FROM orders")
def registered_table(t):
    from .sources.sync import register

    schema = {"name": "orders", "fields": {0: {"name": "id", "type": "integer"}, 2: {"name": "total-price", "type": "float", "remote_name": "price"}}, "total": 3}
    store = state.Store(t.spark, state.shared_folder(t.spark, "register"))
    return register(store, schema, t["orders"].select("o_orderkey", "o_orderstatus", "o_totalprice"), "id").drop("_synced_at")


@query("SELECT o_orderkey AS id, o_custkey AS Field_1, CAST(o_totalprice AS DOUBLE) AS total_price FROM orders")
def read_with_schema(t):
    path = state.shared_folder(t.spark, "positions")
    t["orders"].select(F.col("o_orderkey").cast("string"), "o_custkey", F.col("o_totalprice").cast("string")).write.parquet(path)
    schema = {"name": "orders", "fields": {0: {"name": "id", "type": "integer"}, 2: {"name": "total_price", "type": "float"}}, "total": 3}
    return mapping.read_with_schema(t.spark, path, schema)


# --- profiling -----------------------------------------------------------------------------------------


@query("SELECT count(*) AS row_count, min(o_orderkey) AS min_id, max(o_orderkey) AS max_id, strftime(min(o_orderdate), '%Y-%m-%d') AS first_day, strftime(max(o_orderdate), '%Y-%m-%d') AS last_day FROM orders")
def table_metadata(t):
    m = profile.table_metadata(t["orders"], "o_orderkey")
    return m.select("row_count", "min_id", "max_id", F.date_format("min_o_orderdate", "yyyy-MM-dd").alias("first_day"), F.date_format("max_o_orderdate", "yyyy-MM-dd").alias("last_day"))


_EVENT_COLUMNS = ("event_id", "user_id", "event_type", "props")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS size, count(*) - count({c}) AS null_count, 100.0::DOUBLE * (count(*) - count({c})) / count(*) AS null_percentage, count(DISTINCT {c}) AS unique_count, count(DISTINCT {c})::DOUBLE / count(*) AS cardinality FROM events" for c in _EVENT_COLUMNS))
def profile_columns(t):
    return profile.profile(t["events"].select(*_EVENT_COLUMNS)).drop("top_values")


@query("SELECT * FROM (SELECT 'o_orderstatus' AS column_name, o_orderstatus AS value, count(*) AS n FROM orders GROUP BY ALL UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY ALL)")
def top_values(t):
    p = profile.profile(t["orders"].select("o_orderstatus", "o_orderpriority", "o_orderkey"))
    return p.select("column_name", F.explode("top_values").alias("v")).select("column_name", "v.value", "v.n")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, min({c})::DOUBLE AS min_value, max({c})::DOUBLE AS max_value, round(avg({c}), 6) AS avg_value FROM part" for c in ("p_partkey", "p_size", "p_retailprice")))
def profile_numeric(t):
    return profile.profile_numeric(t["part"]).withColumn("avg_value", F.round("avg_value", 6))


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, min(length({c}))::INTEGER AS min_length, max(length({c}))::INTEGER AS max_length, round(avg(length({c})), 6) AS avg_length FROM part" for c in ("p_name", "p_brand", "p_type")))
def profile_string(t):
    return profile.profile_strings(t["part"]).withColumn("avg_length", F.round("avg_length", 6))


def _share_sql(test: str) -> str:
    return f"avg(CASE WHEN t IS NULL THEN NULL WHEN {test} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)"


#: SQL of the type of a column `t` of texts, narrowest first.
_KIND_SQL = (
    "CASE WHEN count(t) = 0 THEN 'unknown' "
    + f"WHEN {_share_sql(r"regexp_full_match(trim(t), '[+-]?\d+') AND TRY_CAST(t AS BIGINT) IS NOT NULL")} = 1 THEN 'integer' "
    + f"WHEN {_share_sql('TRY_CAST(t AS DOUBLE) IS NOT NULL')} = 1 THEN 'float' WHEN {_share_sql("lower(t) IN ('true', 'false')")} = 1 THEN 'boolean' "
    + f"WHEN {_share_sql(f"regexp_matches(t, '{profile.DATE_ONLY}') AND TRY_CAST(t AS DATE) IS NOT NULL")} = 1 THEN 'date' "
    + f"WHEN {_share_sql(r"regexp_matches(t, '^\d{4}-\d{2}-\d{2}') AND TRY_CAST(t AS TIMESTAMP) IS NOT NULL")} = 1 THEN 'datetime' ELSE 'string' END"
)


def _types_sql(table: str, columns: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT {i} AS position, '{c}' AS column_name, {_KIND_SQL} AS inferred_type FROM (SELECT CAST({e} AS VARCHAR) AS t FROM {table})" for i, (c, e) in enumerate(columns.items()))


def _classes_sql(table: str, columns: dict[str, str], numbers: tuple[str, ...] = ()) -> str:
    """What `profile.classify_columns` says, worked out from the table."""

    def means(test: str) -> str:
        return f"coalesce({_share_sql(test)}, 0) >= 0.9"

    phone = "regexp_replace(trim(t), '[ ()-]', '', 'g')"
    kinds = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS column_name, {_KIND_SQL} AS kind, {str(c in numbers).lower()} AS number, {means(f"regexp_matches(trim(t), '{profile.EMAIL}')")} AS email, {means(f"regexp_matches(trim(t), '{profile.URL}')")} AS url, "
        f"{means(f"regexp_matches(lower(trim(t)), '{profile.UUID}')")} AS uuid, {means(f"regexp_matches({phone}, '{profile.PHONE}') AND NOT regexp_matches({phone}, '{profile.EIGHT_DIGITS}')")} AS phone FROM (SELECT CAST({e} AS VARCHAR) AS t FROM {table})"
        for i, (c, e) in enumerate(columns.items())
    )
    name = (
        "CASE WHEN position = 0 AND kind = 'integer' THEN 'id' WHEN number THEN 'Field_' || position WHEN email THEN 'email' WHEN url THEN 'url' WHEN uuid THEN 'uuid' WHEN phone THEN 'phone' "
        "WHEN kind = 'datetime' AND position = 1 THEN 'created_at' WHEN kind = 'datetime' AND position = 2 THEN 'updated_at' WHEN kind = 'datetime' THEN 'timestamp_' || position WHEN kind = 'date' THEN 'date_' || position ELSE 'Field_' || position END"
    )
    return (
        f"WITH k AS ({kinds}), n AS (SELECT *, {name} AS name FROM k) SELECT position, column_name, kind AS inferred_type, "
        "CASE WHEN row_number() OVER (PARTITION BY name ORDER BY position) > 1 THEN name || '_' || position ELSE name END AS inferred_name FROM n"
    )


@query(_classes_sql("events", {"event_id": "event_id", "ts": "ts", "value": "value", "event_type": "event_type", "day": "CAST(ts AS DATE)"}))
def classify_events(t):
    e = t["events"]
    text = e.select(F.col("event_id").cast("string"), F.col("ts").cast("string"), F.col("value").cast("string"), "event_type", F.to_date("ts").cast("string").alias("day"))
    return profile.classify_columns(text)


@query(_classes_sql("pages", {"page_id": "page_id", "url": "url", "again": "url"}, ("page_id",)))
def classify_pages(t):
    return profile.classify_columns(t["pages"].select("page_id", "url", F.col("url").alias("again")))


_ORDER_TEXTS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")


@query(_types_sql("orders", {c: c for c in _ORDER_TEXTS}))
def infer_types(t):
    return profile.infer_types(t["orders"].select(*(F.col(c).cast("string") for c in _ORDER_TEXTS)))


@query(_classes_sql("events", {"event_id": "event_id", "ts": "ts", "event_type": "event_type"}, ("event_id",)).replace("position, column_name, kind AS inferred_type, CASE", "position, kind AS type, CASE").replace("AS inferred_name FROM n", "AS name FROM n"))
def inferred_schema(t):
    found = mapping.infer_schema(t["events"].select("event_id", "ts", "event_type"))
    return t.spark.createDataFrame([(p, f["type"], f["name"]) for p, f in found["fields"].items()], "position int, type string, name string")


@query("SELECT event_id FROM events WHERE event_id % 2 = 0 AND value > 2")
def policy_rows(t):
    """The rows that the predicate of an ingest policy keeps."""
    flags = t["events"].select("event_id", F.when(F.col("event_id") % 2 == 1, F.col("ts")).alias("deleted_at"), (F.col("value") > 2).alias("active"))
    policy = profile.ingest_policy(profile.policy_metadata(flags, "events"))
    return flags.where(policy.first()["where"]).select("event_id")


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in ("nation", "customer", "orders")))
def introspect_tables(t):
    found = profile.introspect_all({n: t[n] for n in ("nation", "customer", "orders")}, profile.table_metadata)
    rows = [d.select(F.lit(n).alias("table_name"), "row_count") for n, d in found.items()]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


@query("SELECT least(500, count(*)) AS n FROM orders")
def sample_first(t):
    return relational.count_where(relational.sample_rows(t["orders"], 500))


@query(
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, count(*) AS row_count, (CASE WHEN count(*) < 1000 THEN greatest(count(*), 100) WHEN count(*) < 100000 THEN 5000 ELSE 10000 END)::BIGINT AS chunk_size, "
        f"CASE WHEN count(*) >= 100000 OR (count(*) > 10000 AND {'true' if n == 'events' else 'false'}) THEN 'incremental' ELSE 'full' END AS strategy, count(*) < 100000 AS auto_sync, "
        f"(CASE WHEN count(*) < 1000 THEN 3600 WHEN count(*) < 100000 THEN 1800 ELSE 600 END)::BIGINT AS ttl, 2 * count(*) AS row_limit FROM {n}"
        for n in ("nation", "customer", "orders", "lineitem", "events")
    )
)
def ingest_policy(t):
    sizes = None
    for n in ("nation", "customer", "orders", "lineitem", "events"):
        one = t[n].agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count"), F.lit(n == "events").alias("has_update_time"))
        sizes = one if sizes is None else sizes.unionByName(one)
    return profile.ingest_policy(sizes).drop("has_update_time")


_SKETCHED = ("l_orderkey", "l_partkey", "l_quantity", "l_extendedprice", "l_returnflag", "l_shipdate")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS size, count(*) - count({c}) AS null_count, true AS close FROM lineitem" for c in _SKETCHED))
def profile_sketched(t):
    """Sketches of a table's two halves, merged: distinct counts within 3 % of the exact ones."""
    rows = t["lineitem"].select(*_SKETCHED)
    halves = [sketches.sketched(rows.where(F.col("l_orderkey") % 2 == k)) for k in (0, 1)]
    exact = profile.profile(rows, top=0).select("column_name", F.col("unique_count").alias("exact"))
    found = sketches.merged(halves[0].unionByName(halves[1])).join(exact, "column_name")
    return found.select("column_name", "size", "null_count", (F.abs(F.col("unique_count") - F.col("exact")) <= 0.03 * F.col("exact")).alias("close"))


@query(
    "SELECT k AS column_name, count(*) AS size, true AS close FROM orders, (SELECT unnest(['o_orderkey', 'o_custkey', 'o_totalprice']) AS k) GROUP BY k"
)
def profile_grown(t):
    """Quantiles of a stored table that has grown by a merge since its first profile, by exact ranks: off by 2 % of the rows at most."""
    store, names = state.Store(t.spark, state.shared_folder(t.spark, "grown")), ["o_orderkey", "o_custkey", "o_totalprice"]
    rows = t["orders"].select(*names)
    half = F.col("o_orderkey") <= rows.agg(F.max("o_orderkey") / 2).scalar()
    store.write("o", merge.stamp(rows.where(half)), key="o_orderkey", buckets=8)
    sketches.profile_stored(store, "o")
    store.merge("o", rows.where(~half), "o_orderkey")
    found = sketches.profile_stored(store, "o").where(F.col("quantiles").isNotNull())
    at = found.select("column_name", "size", F.posexplode("quantiles").alias("i", "q"))
    cells = rows.unpivot([], [F.col(c).cast("double").alias(c) for c in names], "column_name", "value")
    ranks = cells.join(F.broadcast(at), "column_name").groupBy("column_name", "size", "i").agg(F.count_if(F.col("value") < F.col("q")).alias("below"), F.count_if(F.col("value") <= F.col("q")).alias("upto"))
    want = F.col("i") / 4 * F.col("size")
    off = F.greatest(F.col("below") - want, want - F.col("upto"))
    return ranks.groupBy("column_name", "size").agg((F.max(off) <= 0.02 * F.max("size")).alias("close"))


# --- validation ----------------------------------------------------------------------------------------


def _altered(t) -> DataFrame:
    return t["customer"].select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_name")).alias("name"), F.when(F.col("c_custkey") % 3 == 0, F.lit("X")).otherwise(F.col("c_mktsegment")).alias("segment"), F.col("c_nationkey").alias("nation"))


_MAPPED = (("c_name", "name"), ("c_mktsegment", "segment"), ("c_nationkey", "nation"))


@query(
    "WITH a AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_name END AS name, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS segment, c_nationkey AS nation FROM customer), m AS ("
    + " UNION ALL ".join(f"SELECT '{x}' AS left_col, '{y}' AS right_col, count(*) AS rows, count_if(c.{x} IS NOT DISTINCT FROM a.{y})::BIGINT AS matches, avg(CASE WHEN c.{x} IS NOT DISTINCT FROM a.{y} THEN 1.0::DOUBLE ELSE 0.0 END) AS match_ratio, count(DISTINCT c.{x}) AS unique_count FROM customer c JOIN a USING (c_custkey)" for x, y in _MAPPED)
    + ") SELECT *, CASE WHEN match_ratio >= 0.95 THEN 'pass' WHEN match_ratio >= 0.8 THEN 'warn' ELSE 'fail' END AS verdict FROM m UNION ALL SELECT 'c_name', 'gone', NULL, NULL, NULL, NULL, 'fail'"
)
def mapping_report(t):
    report = checks.validate_mapping(t["customer"], _altered(t), "c_custkey", dict(_MAPPED))
    report = report.unionByName(checks.validate_mapping(t["customer"], _altered(t), "c_custkey", {"c_name": "gone"}))
    return report.select("left_col", "right_col", "rows", "matches", "match_ratio", "unique_count", "verdict")


@query(
    "SELECT 'o_totalprice' AS column_name, 'ge' AS rule, count_if(o_totalprice < 1000)::BIGINT AS violations FROM orders UNION ALL SELECT 'o_orderstatus', 'max_length', count_if(length(o_orderstatus) > 1)::BIGINT FROM orders "
    "UNION ALL SELECT 'o_orderpriority', 'not_blank', count_if(length(trim(o_orderpriority)) = 0)::BIGINT FROM orders UNION ALL SELECT 'o_custkey', 'not_null', count_if(o_custkey IS NULL)::BIGINT FROM orders "
    "UNION ALL SELECT 'o_custkey', 'unique', count(*) - count(DISTINCT o_custkey) FROM orders UNION ALL SELECT 'o_orderkey', 'primary_key', count(*) - count(DISTINCT o_orderkey) FROM orders"
)
def constraint_report(t):
    return checks.check_constraints(t["orders"], {"o_totalprice": {"ge": 1000}, "o_orderstatus": {"max_length": 1}, "o_orderpriority": {"not_blank": True}, "o_custkey": {"not_null": True, "unique": True}, "o_orderkey": {"primary_key": True}})


@query(
    "SELECT 'c_mktsegment' AS left_col, 'segment' AS right_col, count(*) AS rows, count_if(s = c_mktsegment)::BIGINT AS matches, avg(CASE WHEN s = c_mktsegment THEN 1.0::DOUBLE ELSE 0.0 END) AS match_ratio, CASE WHEN count_if(s = c_mktsegment) >= 0.95 * count(*) THEN 'pass' WHEN count_if(s = c_mktsegment) >= 0.8 * count(*) THEN 'warn' ELSE 'fail' END AS verdict, "
    "count_if(c_mktsegment IS NULL)::BIGINT AS null_count, count(DISTINCT c_mktsegment) AS unique_count, min(c_mktsegment) AS min_value, max(c_mktsegment) AS max_value FROM (SELECT *, CASE WHEN c_custkey % 3 = 0 THEN 'X' ELSE c_mktsegment END AS s FROM customer)"
)
def match_ratio(t):
    return checks.match_ratio(t["customer"], _altered(t), "c_custkey", "c_mktsegment", "segment")


@query("SELECT 'o_orderstatus' AS column_name, 'validator' AS rule, count_if(o_orderstatus NOT IN ('F', 'O'))::BIGINT AS violations FROM orders")
def user_validator(t):
    return checks.check_constraints(t["orders"], {"o_orderstatus": {"validator": lambda c: c.isin("F", "O")}})


@query("SELECT o_orderkey, o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)")
def orphans(t):
    return checks.orphans(t["orders"].select("o_orderkey", "o_custkey"), t["customer"].where("c_acctbal > 0"), "o_custkey", "c_custkey")


@query(
    "WITH a AS (SELECT row_number() OVER () - 1 AS p, column_name AS f, column_type AS t FROM (DESCRIBE orders)), "
    "b AS (SELECT row_number() OVER () - 1 AS p, column_name AS f, column_type AS t FROM (DESCRIBE (SELECT o_custkey, o_orderkey, o_orderstatus, o_totalprice::VARCHAR AS o_totalprice, o_orderdate, o_orderpriority AS priority FROM orders))) "
    "SELECT field, change, rows FROM (SELECT coalesce(a.f, b.f) AS field, CASE WHEN a.p IS NULL THEN 'added' WHEN b.p IS NULL THEN 'removed' WHEN a.t <> b.t THEN 'retyped' WHEN a.p <> b.p THEN 'moved' END AS change FROM a FULL JOIN b ON a.f = b.f), "
    "(SELECT count(*) AS rows FROM orders) WHERE change IS NOT NULL"
)
def drift(t):
    """Fields that differ between the orders stored first and a later load of them with other columns."""
    store, orders = state.Store(t.spark, state.shared_folder(t.spark, "drift")), t["orders"]
    store.write("orders", orders)
    store.write("orders", orders.selectExpr("o_custkey", "o_orderkey", "o_orderstatus", "CAST(o_totalprice AS string) AS o_totalprice", "o_orderdate", "o_orderpriority AS priority"))
    now = store.read("orders")
    return checks.schema_drift(store.read("orders", 1), now).select("field", "change").crossJoin(now.agg(F.count("*").alias("rows")))


# --- merge and sync ------------------------------------------------------------------------------------

_NOW = "TIMESTAMP '2024-01-01 00:00:00'"


def _batches(t) -> tuple[DataFrame, DataFrame]:
    """A stored table of users by their events before a cut, so early that many users are new, and all events past it as the batch."""
    e = t["events"].select("user_id", "event_id", "event_type", "value")
    cut = e.agg((F.max("event_id") / 100).alias("cut")).scalar()
    old, new = e.where(F.col("event_id") <= cut), e.where(F.col("event_id") > cut)
    return merge.stamp(merge.per_key(old, "user_id", "event_id").drop("_rows")), new


_SPLIT = (
    "WITH e AS (SELECT user_id, event_id, event_type, value FROM events), c AS (SELECT max(event_id) / 100 AS cut FROM e), "
    "o AS (SELECT user_id, max(event_id) AS event_id FROM e, c WHERE event_id <= cut GROUP BY user_id), "
    "b AS (SELECT user_id, max(event_id) AS last_id, min(event_id) AS first_id, count(*) AS n FROM e, c WHERE event_id > cut GROUP BY user_id) "
)


@query(_SPLIT + "SELECT user_id, coalesce(b.last_id, o.event_id) AS event_id, e.event_type, e.value, (CASE WHEN o.user_id IS NULL THEN 0 ELSE 1 END + coalesce(b.n, 0))::BIGINT AS _sync_version FROM o FULL JOIN b USING (user_id) JOIN e USING (user_id) WHERE e.event_id = coalesce(b.last_id, o.event_id)")
def upsert_versions(t):
    old, new = _batches(t)
    return merge.upsert(old, new, "user_id", "event_id").drop("_synced_at", "_is_partial")


@query(_SPLIT + "SELECT count(*) FILTER (o.user_id IS NULL) AS inserted, (sum(n) - count(*) FILTER (o.user_id IS NULL))::BIGINT AS updated FROM b LEFT JOIN o USING (user_id)")
def upsert_counts(t):
    old, new = _batches(t)
    return merge.upsert_counts(old, new, "user_id")


@query(_SPLIT + "SELECT user_id, coalesce(b.last_id, o.event_id) AS event_id, 1::BIGINT AS _sync_version FROM o FULL JOIN b USING (user_id)")
def insert_replace(t):
    old, new = _batches(t)
    return merge.bulk_insert(old, new, "user_id", "REPLACE", "event_id").select("user_id", "event_id", "_sync_version")


@query(_SPLIT + "SELECT user_id, coalesce(o.event_id, b.first_id) AS event_id, 1::BIGINT AS _sync_version FROM o FULL JOIN b USING (user_id)")
def insert_ignore(t):
    old, new = _batches(t)
    return merge.bulk_insert(old, new, "user_id", "IGNORE", "event_id").select("user_id", "event_id", "_sync_version")


@query("SELECT event_type, max(event_id) AS event_id, count(*) AS _rows FROM (SELECT * FROM events WHERE value > 1 ORDER BY event_id LIMIT 700) GROUP BY event_type")
def sync_full_rows(t):
    from .sources.sync import SyncConfig, source_rows

    cfg = SyncConfig("e", key="event_type", where="value > 1", limit=700, order_by="event_id", include=["event_id", "event_type"])
    return merge.per_key(source_rows(t["events"], cfg), cfg.key, "event_id")


def _loads(t):
    """A store, the events as the source of a table of users, and how they are loaded."""
    from .sources.sync import SyncConfig

    store = state.Store(t.spark, state.shared_folder(t.spark, "sync"))
    return store, t["events"].select("user_id", "event_id", "event_type"), SyncConfig("users", key="user_id", strategy="incremental", incremental_field="event_id")


_LAST = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type"


@query(_LAST + ", 1::BIGINT AS _sync_version FROM events GROUP BY user_id")
def sync_full(t):
    from .sources import sync

    store, events, cfg = _loads(t)
    sync.sync_full(store, events, cfg)
    return store.read("users").select("user_id", "event_id", "event_type", "_sync_version")


@query(_LAST + ", 1::BIGINT AS _sync_version, (SELECT count(*) FROM events WHERE value > 2) AS counted FROM events WHERE value > 2 GROUP BY user_id")
def sync_where(t):
    """A load with an extra predicate, after a dry run that only counts."""
    from .sources import sync

    store, events, cfg = _loads(t)
    source = t["events"].select("user_id", "event_id", "event_type", "value")
    counted = sync.sync_full(store, source, cfg, where="value > 2", dry_run=True)["fetched"]
    sync.sync_full(store, source, cfg, where="value > 2")
    return store.read("users").select("user_id", "event_id", "event_type", "_sync_version", F.lit(counted).cast("long").alias("counted"))


_CUT = "(SELECT max(event_id) / 2 FROM events)"


@query(_LAST + f", (CASE WHEN bool_or(event_id <= {_CUT}) THEN 1 ELSE 0 END + count(*) FILTER (event_id > {_CUT}))::BIGINT AS _sync_version FROM events GROUP BY user_id")
def sync_incremental(t):
    from .sources import sync

    store, events, cfg = _loads(t)
    sync.sync(store, events.where(F.col("event_id") <= events.agg(F.max("event_id") / 2).scalar()), cfg)
    sync.sync(store, events, cfg, force=True)
    return store.read("users").select("user_id", "event_id", "event_type", "_sync_version")


_LATE = "(SELECT max(event_id) - 7 FROM events)"


@query(_LAST + f", (CASE WHEN bool_or(event_id <= {_LATE}) THEN 1 ELSE 0 END + count(*) FILTER (event_id > {_LATE}))::BIGINT AS _sync_version FROM events GROUP BY user_id")
def upsert_buckets(t):
    """A narrow batch merged into a table of 16 hash buckets: only those of its few users are written."""
    store, events, cfg = _loads(t)
    late = events.agg(F.max("event_id") - 7).scalar()
    cfg.buckets = 16
    store.write("users", merge.stamp(merge.per_key(events.where(F.col("event_id") <= late), "user_id", "event_id").drop("_rows")), **cfg.layout)
    store.merge("users", events.where(F.col("event_id") > late), "user_id", "event_id")
    return store.read("users").select("user_id", "event_id", "event_type", "_sync_version")


@query(
    "WITH s AS (SELECT count(DISTINCT user_id) AS users, arg_max(user_id, event_id) AS last FROM events), "
    "k AS (SELECT * FROM (VALUES (1, 'write'), (2, 'merge'), (3, 'merge')) AS v(version, kind)) "
    "SELECT version::BIGINT AS version, kind, CASE WHEN kind = 'write' THEN NULL ELSE 1 END::BIGINT AS changed, (SELECT count(*) FROM events WHERE user_id = s.last)::BIGINT AS events, users FROM k, s"
)
def commit_log(t):
    """What the log says of a table that was written and then got one user's events twice: one bucket each time."""
    store, events, cfg = _loads(t)
    cfg.buckets = 8
    store.write("users", merge.stamp(merge.per_key(events, "user_id", "event_id").drop("_rows")), **cfg.layout)
    one = events.where(F.col("user_id") == events.agg(F.max_by("user_id", "event_id")).scalar())
    for _ in range(2):
        store.merge("users", one, "user_id", "event_id")
    log = store.commits("users").select("version", "kind", F.when(F.col("kind") == "merge", F.col("changed")).alias("changed"))
    figures = one.agg(F.count("*").alias("events")).crossJoin(store.read("users").agg(F.count("*").alias("users")))
    return log.crossJoin(figures)


@query(
    f"WITH a AS (SELECT count(*) AS n, count(DISTINCT user_id) AS u, max(event_id) AS m FROM events WHERE event_id <= {_CUT}), b AS (SELECT count(*) AS n, count(DISTINCT user_id) AS u, max(event_id) AS m FROM events), "
    f"i AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id <= {_CUT})) "
    "SELECT 'users' AS \"table\", 'completed' AS status, n AS fetched, u AS inserted, 0::BIGINT AS updated, u AS row_count, CAST(m AS VARCHAR) AS checkpoint FROM a "
    "UNION ALL SELECT 'users', 'completed', b.n - a.n, i.n, b.n - a.n - i.n, b.u, CAST(b.m AS VARCHAR) FROM a, b, i UNION ALL SELECT 'users', 'failed', NULL, NULL, NULL, NULL, NULL"
)
def sync_history(t):
    from .sources import sync

    store, events, cfg = _loads(t)
    sync.sync(store, events.where(F.col("event_id") <= events.agg(F.max("event_id") / 2).scalar()), cfg)
    sync.sync(store, events, cfg, force=True)
    sync.sync(store, events, cfg)  # not due: no run
    sync.sync(store, events.drop("event_id"), cfg, force=True)
    return store.history().select("table", "status", "fetched", "inserted", "updated", "row_count", "checkpoint")


@query(" UNION ALL ".join(f"SELECT '{n}' AS \"table\", count(*) AS row_count, CAST(min({k}) AS VARCHAR) AS min_id, CAST(max({k}) AS VARCHAR) AS max_id FROM {n}" for n, k in (("customer", "c_custkey"), ("orders", "o_orderkey"), ("part", "p_partkey"))))
def sync_many(t):
    from .sources import sync

    store = state.Store(t.spark, state.shared_folder(t.spark, "sync"))
    keys = {"customer": "c_custkey", "orders": "o_orderkey", "part": "p_partkey"}
    sync.sync_all(store, [(lambda n=n: t[n], sync.SyncConfig(n, key=k)) for n, k in keys.items()])
    return store.state().select("table", "row_count", "min_id", "max_id")


@query("SELECT c_custkey, c_name, true AS _is_partial FROM customer WHERE c_nationkey = 7 OR c_acctbal > 5000")
def fetch_on_demand(t):
    from .sources import sync

    store = state.Store(t.spark, state.shared_folder(t.spark, "sync"))
    cfg = sync.SyncConfig("customer", key="c_custkey", strategy="on_demand")
    sync.fetch_on_demand(store, t["customer"], cfg, c_nationkey=7)
    sync.fetch_on_demand(store, t["customer"], cfg, c_acctbal__gt=5000)
    return store.read("customer").select("c_custkey", "c_name", "_is_partial")


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, count(*) AS size, count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS unique_count FROM customer" for c in ("c_custkey", "c_mktsegment", "c_nationkey")))
def profile_synced(t):
    from .sources import sync

    store = state.Store(t.spark, state.shared_folder(t.spark, "sync"))
    sync.sync_full(store, t["customer"], sync.SyncConfig("customer", key="c_custkey", include=["c_custkey", "c_mktsegment", "c_nationkey"]))
    return profile.profile(relational.read_synced(store.read("customer"))).select("column_name", "size", "null_count", "unique_count")


def _runs(t) -> DataFrame:
    """A sync history derived from the events: each event is a run of a table named by its type."""
    e = t["events"]
    failed = F.col("event_type") == "error"
    wide = e.select(
        F.concat_ws("_", "event_type", F.col("user_id") % 3).alias("table"),
        F.when(F.col("value") < 3, "failed").otherwise("completed").alias("status"),
        F.col("ts").alias("started_at"),
        (F.col("ts") + F.expr("INTERVAL 1 SECOND")).alias("finished_at"),
        F.when(~failed, F.col("ts") + F.expr("INTERVAL 30 DAYS")).alias("next_sync_at"),
        F.col("event_id").cast("string").alias("checkpoint"),
        F.col("event_id").alias("row_count"),
        F.when(F.col("value") < 3, F.lit("broken")).alias("error"),
    )
    return wide


_RUNS = "WITH r AS (SELECT concat_ws('_', event_type, user_id % 3) AS tab, CASE WHEN value < 3 THEN 'failed' ELSE 'completed' END AS status, ts, event_id, CASE WHEN event_type <> 'error' THEN ts + INTERVAL 30 DAY END AS due FROM events) "


@query(_RUNS + "SELECT tab AS \"table\", CASE WHEN due IS NULL THEN 'unknown' WHEN due < TIMESTAMP '2024-02-10' THEN 'stale' ELSE 'fresh' END AS freshness FROM (SELECT tab, due, row_number() OVER (PARTITION BY tab ORDER BY ts DESC) AS k FROM r) WHERE k = 1")
def sync_status(t):
    from datetime import datetime

    return state.sync_status(state.sync_state(_runs(t)), datetime(2024, 2, 10))


@query(_RUNS + "SELECT count(DISTINCT tab) AS tables, count_if(status = 'completed')::BIGINT AS syncs, count_if(status = 'failed')::BIGINT AS failures FROM r")
def sync_totals(t):
    return state.sync_totals(state.sync_state(_runs(t))).drop("rows")


# --- export --------------------------------------------------------------------------------------------


@query("SELECT ((o_orderkey - m) // 1000)::BIGINT AS chunk, count(*) AS rows FROM orders, (SELECT min(o_orderkey) AS m FROM orders) GROUP BY ALL")
def id_chunks(t):
    return export.chunk_manifest(export.id_chunks(t["orders"], "o_orderkey", 1000)).select("chunk", "rows")


@query("SELECT o_orderkey, o_totalprice, o_orderpriority, ((row_number() OVER (ORDER BY o_orderkey) - 1) // 700)::BIGINT AS chunk FROM orders")
def offset_chunks(t):
    rows = t["orders"].select("o_orderkey", "o_totalprice", "o_orderpriority")
    return export.offset_chunks(rows, ["o_orderkey"], 700).withColumnRenamed("_chunk", "chunk")


@query("SELECT o_orderkey FROM (SELECT o_orderkey, (o_orderkey - min(o_orderkey) OVER ()) // 1000 AS chunk FROM orders) WHERE chunk % 3 <> 0")
def resume_chunks(t):
    chunked = export.id_chunks(t["orders"].select("o_orderkey"), "o_orderkey", 1000)
    return export.pending(chunked, export.chunk_manifest(chunked).where("chunk % 3 = 0")).select("o_orderkey")


@query("SELECT ((o_orderkey - m) // 1000)::BIGINT AS chunk, count(*) AS rows FROM orders, (SELECT min(o_orderkey) AS m FROM orders) GROUP BY ALL")
def export_manifest(t):
    path = state.shared_folder(t.spark, "export")
    export.export(t["orders"], path, "parquet", key="o_orderkey", size=1000)
    return export.manifest(t.spark, path).select("chunk", "rows")


@query("SELECT o_orderkey, o_totalprice FROM orders")
def export_resumed(t):
    """Half of the rows first, then all: chunks that gained rows are written again."""
    path, rows = state.shared_folder(t.spark, "export"), t["orders"].select("o_orderkey", "o_totalprice")
    export.export(rows.where("o_orderkey % 2 = 1"), path, "parquet", key="o_orderkey", size=1000)
    export.export(rows, path, "parquet", key="o_orderkey", size=1000)
    return export.read_export(t.spark, path, "parquet", rows.schema)


@query("SELECT o_orderkey, o_totalprice, o_orderdate FROM orders WHERE o_totalprice > 100000 AND o_orderstatus = 'F'")
def export_filtered(t):
    """Only the rows of a predicate, in chunks by date and price."""
    path, rows = state.shared_folder(t.spark, "export"), t["orders"].select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderstatus")
    export.export(rows, path, "jsonl", order_by=["o_orderdate", "o_totalprice", "o_orderkey"], size=700, where="o_totalprice > 100000 AND o_orderstatus = 'F'")
    return export.read_export(t.spark, path, "jsonl", rows.schema).drop("o_orderstatus")


@query("SELECT ((row_number() OVER (ORDER BY o_orderdate, o_totalprice, o_orderkey) - 1) // 700)::BIGINT AS chunk, o_orderkey, (row_number() OVER (ORDER BY o_orderdate, o_totalprice, o_orderkey) - 1) % 700 AS place FROM orders WHERE o_totalprice > 100000")
def export_order(t):
    """Where each row stands in the files of an ordered export: its chunk and its place there."""
    path, rows = state.shared_folder(t.spark, "export"), t["orders"].select("o_orderkey", "o_totalprice", "o_orderdate")
    export.export(rows, path, "parquet", order_by=["o_orderdate", "o_totalprice", "o_orderkey"], size=700, where="o_totalprice > 100000")
    written = t.spark.read.parquet(path)
    return written.select(F.col("_chunk").cast("long").alias("chunk"), "o_orderkey", F.col("_metadata.row_index").alias("place"))


@query("SELECT doc_id, text, lang, source, n_chars, '' AS empty, NULL::VARCHAR AS nothing, chr(10) || ' \"' || source || '\" ,' || chr(13) || ' ' AS odd FROM documents")
def export_csv_texts(t):
    """Whole texts through CSV: line breaks, quotes, blanks at both ends, empty and null."""
    path = state.shared_folder(t.spark, "export")
    odd = F.concat(F.lit('\n "'), "source", F.lit('" ,\r '))
    rows = t["documents"].select("doc_id", "text", "lang", "source", "n_chars", F.lit("").alias("empty"), F.lit(None).cast("string").alias("nothing"), odd.alias("odd"))
    export.export(rows, path, "csv", key="doc_id", size=1000)
    return export.read_export(t.spark, path, "csv", rows.schema)


@query("SELECT nullif(o_custkey, (SELECT min(o_custkey) FROM orders)) AS k, o_orderkey FROM orders")
def export_null_keys(t):
    path, low = state.shared_folder(t.spark, "export"), t["orders"].agg(F.min("o_custkey")).scalar()
    rows = t["orders"].select(F.nullif("o_custkey", low).alias("k"), "o_orderkey")
    export.export(rows, path, "parquet", key="k", size=100)
    return export.read_export(t.spark, path, "parquet", rows.schema)


@query("SELECT o_orderkey, (SELECT count(DISTINCT (o_orderkey - m) // 1000) FROM orders, (SELECT min(o_orderkey) AS m FROM orders) WHERE o_orderkey <= h) AS chunks FROM orders, (SELECT max(o_orderkey) / 2 AS h FROM orders) WHERE o_orderkey <= h")
def export_shrunk(t):
    """All rows first, then the lower half of the keys: what the source lost is gone from the folder and the manifest."""
    path, rows = state.shared_folder(t.spark, "export"), t["orders"].select("o_orderkey")
    export.export(rows, path, "parquet", key="o_orderkey", size=1000)
    export.export(rows.where(F.col("o_orderkey") <= rows.agg(F.max("o_orderkey") / 2).scalar()), path, "parquet", key="o_orderkey", size=1000)
    return export.read_export(t.spark, path, "parquet", rows.schema).withColumn("chunks", F.lit(export.manifest(t.spark, path).count()).cast("long"))


@query(" UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*)::DECIMAL(38, 0)::BIGINT AS rows FROM {n}" for n in ("customer", "part")))
def export_many(t):
    stats = export.export_all({n: t[n].withColumnRenamed(k, "id") for n, k in (("customer", "c_custkey"), ("part", "p_partkey"))}, state.shared_folder(t.spark, "export"), "jsonl", key="id")
    rows = [d.select(F.lit(n).alias("table_name"), F.col("rows").cast("long").alias("rows")) for n, d in stats.items()]
    return rows[0].unionByName(rows[1])


@query("SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY ALL")
def stored_result(t):
    cache = export.ResultCache(t.spark, state.shared_folder(t.spark, "results"))
    request_ = {"data": ["o_orderstatus", {"function": "count", "args": ["*"], "as": "n"}], "from": "orders", "group_by": ["o_orderstatus"]}
    cache.result({"method": "select", "params": request_}, "orders", lambda: run_select(request_, t))
    return cache.result({"params": request_, "method": "select"}, "orders", lambda: t["orders"].limit(0))


def _roundtrip(kind: str):
    def f(t: Source) -> DataFrame:
        rows, path = t["customer"], state.shared_folder(t.spark, f"export-{kind}")
        export.write_chunks(export.id_chunks(rows, "c_custkey", 500), path, kind)
        return export.read_export(t.spark, path, kind, rows.schema)

    f.__name__ = f"export_roundtrip_{kind}"
    query("SELECT * FROM customer")(f)


for _kind in ("jsonl", "json", "csv", "parquet"):
    _roundtrip(_kind)


_STREAMED = "SELECT user_id, max(event_id) AS event_id, arg_max(event_type, event_id) AS event_type, count(*) AS _sync_version FROM events GROUP BY user_id"


@query(_STREAMED)
def stream_incremental(t):
    return _streamed(t, 0)


@query(_STREAMED)
def stream_bucketed(t):
    """The same stream into a table of hash buckets."""
    return _streamed(t, 8)


def _streamed(t, buckets: int) -> DataFrame:
    base = state.shared_folder(t.spark, "stream")
    rows = t["events"].select("user_id", "event_id", "event_type")
    high = rows.agg(F.max("event_id")).scalar()
    rows.repartitionByRange(3, (F.col("event_id") * 3 / (high + 1)).cast("int")).write.parquet(f"{base}/in")
    store = state.Store(t.spark, f"{base}/store")
    return stream_into(store, f"{base}/in", rows.schema, "users", "user_id", "event_id", f"{base}/checkpoint", buckets=buckets).select("user_id", "event_id", "event_type", "_sync_version")
