"""Plans and edge cases of mark joins, range joins, ordered tables, SQL text and exports."""

from concurrent.futures import ThreadPoolExecutor
from datetime import date, datetime, timedelta
from decimal import Decimal

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill import queries
from gristmill.operators import intervals
from gristmill.plans.select import query_sql, run_select
from gristmill.sources import export, ordered


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["not_in_or", "not_in_or_nulls", "join_band", "join_range"])
def test_no_nested_loops(spark, sf, name):
    text = plan(queries.QUERIES[name](spark, sf))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_mark_join_like_sql(spark):
    """Every pair of a value and a set, with nulls on both sides, as Spark's own predicate says."""
    values = spark.createDataFrame([(k, v) for k, v in enumerate([1, 2, None, 1])], "k int, v int")
    for some in ([], [1], [1, None], [None], [3]):
        sets = spark.createDataFrame([(x,) for x in some], "s int")
        tables = {"v": values, "s": sets}
        sub = {"select": {"data": ["s"], "from": "s"}}
        for where, sql in (
            ({"or": [{"eq": ["k", 3]}, {"not": {"in": ["v", sub]}}]}, "k = 3 OR v NOT IN (SELECT s FROM s)"),
            ({"not": {"or": [{"eq": ["k", 3]}, {"in": ["v", sub]}]}}, "NOT (k = 3 OR v IN (SELECT s FROM s))"),
            ({"and": [{"or": [{"in": ["v", sub]}, {"is": [{"function": "nullif", "args": ["v", {"lit": 2}]}, None]}]}, {"lt": ["k", 3]}]}, "(v IN (SELECT s FROM s) OR nullif(v, 2) IS NULL) AND k < 3"),
            ({"or": [{"not": {"in": ["k", [0, 1]]}}, {"not": {"not": {"in": ["v", sub]}}}]}, "k NOT IN (0, 1) OR NOT (v NOT IN (SELECT s FROM s))"),
        ):
            got = sorted(r.k for r in run_select({"data": ["k"], "from": "v", "where": where}, tables).collect())
            assert got == sorted(r.k for r in query_sql(tables, f"SELECT k FROM v WHERE {sql}").collect()), (some, sql)


def test_range_join_against_all_pairs(spark):
    rng = np.random.default_rng(5)
    spans = [(k, float(lo), float(lo + w)) for k, (lo, w) in enumerate(zip(rng.normal(0, 50, 200), rng.choice([0, 1e-9, 0.3, 7, 900, -1], 200), strict=True))]
    spans += [(900, None, 1.0), (901, 1.0, None), (902, 0.0, 0.0), (903, -0.0, 1e300), (904, 5.0, 5.0)]
    dots = [(k, float(x)) for k, x in enumerate([*rng.normal(0, 60, 300), 0.0, -0.0, 5.0, 1e300])] + [(999, None)] + [(1000 + k, s[1]) for k, s in enumerate(spans[:50])]
    p, i = spark.createDataFrame(dots, "p long, x double"), spark.createDataFrame(spans, "i long, lo double, hi double")
    got = sorted((r.p, r.i) for r in intervals.range_join(p, i, F.col("x"), F.col("lo"), F.col("hi")).collect())
    assert got == sorted((a, b) for a, x in dots for b, lo, hi in spans if None not in (x, lo, hi) and lo <= x <= hi)
    inside = intervals.range_join(p, i, F.col("x"), F.col("lo"), F.col("hi"), F.col("p") > F.col("i"), open_low=True, open_high=True)
    assert sorted((r.p, r.i) for r in inside.collect()) == sorted((a, b) for a, x in dots for b, lo, hi in spans if a > b and None not in (x, lo, hi) and lo < x < hi)
    assert intervals.range_join(p, i.limit(0), F.col("x"), F.col("lo"), F.col("hi")).count() == 0


def test_band_join_of_days_and_times(spark):
    days = [date(2024, 1, 1) + timedelta(k * k % 97) for k in range(60)]
    times = [datetime(2024, 3, 31) + timedelta(minutes=17 * k) for k in range(200)]
    d = spark.createDataFrame([(k, x) for k, x in enumerate(days)], "k long, d date")
    got = intervals.band_join(d.alias("a"), d.alias("b"), F.col("a.d"), F.col("b.d"), 2, 1, F.col("a.k") < F.col("b.k")).select("a.k", "b.k").collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a, x in enumerate(days) for b, y in enumerate(days) if a < b and -2 <= (y - x).days <= 1)
    t = spark.createDataFrame([(k, x) for k, x in enumerate(times)], "k long, t timestamp_ntz")
    hour = F.expr("INTERVAL 1 HOUR")
    got = intervals.band_join(t.alias("a"), t.alias("b"), F.col("a.t"), F.col("b.t"), hour, hour).select("a.k", "b.k").collect()
    assert sorted(map(tuple, got)) == sorted((a, b) for a, x in enumerate(times) for b, y in enumerate(times) if abs((y - x).total_seconds()) <= 3600)


def test_copies_of_a_value_meet_an_interval_once(spark, sf):
    below = queries.QUERIES["join_band"](spark, sf)._jdf.queryExecution().optimizedPlan().toString().partition("Join Inner")[2]
    assert "Aggregate [l_shipdate" in below
    many = spark.range(3_000_000).select((F.col("id") % 3).alias("x"), "id")
    spans = spark.range(20_000).select("id", F.lit(0).alias("lo"), (F.col("id") % 4).alias("hi"))
    spec = {
        "data": ["s.id", {"function": "count", "args": ["*"], "as": "n"}, {"function": "sum", "args": ["m.id"], "as": "ids"}, {"function": "max", "args": ["m.id"], "as": "most"}],
        "from": [{"table": "many", "as": "m"}, {"join": "spans", "as": "s", "on": {"and": [{"gt": [{"m": "x"}, {"s": "lo"}]}, {"lte": [{"m": "x"}, {"s": "hi"}]}]}}],
        "group_by": ["s.id"],
    }  # 25 thousand million pairs
    n, ids = 1_000_000, 3 * 1_000_000 * 999_999 // 2
    want = [(n, ids + n, 2_999_998, 5_000), (2 * n, 2 * ids + 3 * n, 2_999_999, 10_000)]
    assert sorted(map(tuple, run_select(spec, {"many": many, "spans": spans}).groupBy("n", "ids", "most").count().collect())) == want


def test_band_of_times_like_sql(spark, sf, tmp_path):
    """Orders and line items at times of day, some without a date or a key."""
    db = duckdb.connect()
    db.sql(f"CREATE TABLE orders AS SELECT * REPLACE (CASE WHEN o_orderkey % 7 > 0 THEN o_orderdate + to_seconds(o_orderkey * 977 % 86400) END AS o_orderdate) FROM '{sf}/orders.parquet'")
    db.sql(f"CREATE TABLE lineitem AS SELECT * REPLACE (CASE WHEN l_linenumber > 1 THEN l_shipdate + to_seconds(l_orderkey * l_linenumber % 3 * 7919) END AS l_shipdate, nullif(l_orderkey, 5) AS l_orderkey) FROM '{sf}/lineitem.parquet'")
    for name in ("orders", "lineitem"):
        db.sql(f"COPY {name} TO '{tmp_path}/{name}.parquet' (FORMAT parquet)")
    got = queries.QUERIES["join_band"](spark, f"file://{tmp_path}").collect()
    assert sorted(map(tuple, got)) == sorted(db.sql(queries.ORACLES["join_band"]).fetchall())


RANGE = "p.x >= i.lo AND p.x < i.hi"


@pytest.mark.parametrize(
    "data, more, sql",
    [
        (["i.k", "sum p.v", "count p.v", "min p.x", "max p.t"], {"group_by": ["i.k"]}, "SELECT i.k, sum(p.v), count(p.v), min(p.x), max(p.t) FROM p JOIN i ON RANGE GROUP BY i.k"),
        (["p.g", "count *", "sum i.k"], {"group_by": ["p.g"]}, "SELECT p.g, count(*), sum(i.k) FROM p JOIN i ON RANGE GROUP BY p.g"),
        (["p.g", "i.k", "count *", "sum p.v"], {"group_by": ["p.g", "i.k"]}, "SELECT p.g, i.k, count(*), sum(p.v) FROM p JOIN i ON RANGE GROUP BY p.g, i.k"),
        (["count *", "count p.v", "sum p.v"], {}, "SELECT count(*), count(p.v), sum(p.v) FROM p JOIN i ON RANGE"),
        (["count *", "sum p.w"], {"where": {"gt": ["i.k", 10_000]}}, "SELECT count(*), sum(p.w) FROM p JOIN i ON RANGE WHERE i.k > 10000"),
        (["i.k", "sum p.w"], {"group_by": ["i.k"], "where": {"or": [{"is": ["p.v", None]}, {"lt": ["p.g", 2]}]}}, "SELECT i.k, sum(p.w) FROM p JOIN i ON RANGE WHERE p.v IS NULL OR p.g < 2 GROUP BY i.k"),
        (["i.k", "max p.w"], {"group_by": ["i.k"], "on": [{"neq": ["p.g", {"i": "k"}]}, {"not": {"in": ["p.g", [1, 4]]}}]}, "SELECT i.k, max(p.w) FROM p JOIN i ON RANGE AND p.g <> i.k AND p.g NOT IN (1, 4) GROUP BY i.k"),
        (["i.k", "sum p.w"], {"group_by": ["i.k"], "having": {"gt": [{"function": "COUNT", "args": ["*"]}, 12]}}, "SELECT i.k, sum(p.w) FROM p JOIN i ON RANGE GROUP BY i.k HAVING count(*) > 12"),
        # What isn't grouped first: both sides, other aggregates, distinct values, columns without a table, subqueries.
        (["i.k", "sum p.w", "sum i.lo"], {"group_by": ["i.k"]}, "SELECT i.k, sum(p.w), sum(i.lo) FROM p JOIN i ON RANGE GROUP BY i.k"),
        (["i.k", "avg p.w", "count *"], {"group_by": ["i.k"]}, "SELECT i.k, avg(p.w), count(*) FROM p JOIN i ON RANGE GROUP BY i.k"),
        (["k", "sum w"], {"group_by": ["k"]}, "SELECT k, sum(w) FROM p JOIN i ON RANGE GROUP BY k"),
        (["i.k", "count p.w distinct"], {"group_by": ["i.k"]}, "SELECT i.k, count(DISTINCT p.w) FROM p JOIN i ON RANGE GROUP BY i.k"),
        (["i.k", "sum p.w"], {"group_by": ["i.k"], "where": {"in": ["p.g", {"select": {"data": ["k"], "from": "i"}}]}}, "SELECT i.k, sum(p.w) FROM p JOIN i ON RANGE WHERE p.g IN (SELECT k FROM i) GROUP BY i.k"),
    ],
)
@pytest.mark.parametrize("turned", [False, True])
def test_aggregates_over_ranges_like_sql(spark, data, more, sql, turned):
    """Values, types and names; points on either side, copies, nulls and intervals of no length among the rows."""
    rng = np.random.default_rng(7)
    some = lambda x, k, step=5: None if k % step == 0 else x
    dots = [(int(rng.integers(6)), some(float(x), k, 11), some(Decimal(int(x * 7)) / 100, k), int(rng.integers(100)), f"t{k % 9}") for k, x in enumerate(rng.integers(0, 12, 150))]
    spans = [(some(k % 13, k, 17), some(float(lo), k, 9), float(lo + w)) for k, (lo, w) in enumerate(zip(rng.integers(0, 12, 60), rng.integers(-1, 5, 60), strict=True))]
    tables = {"p": spark.createDataFrame(dots, "g int, x double, v decimal(9, 2), w long, t string"), "i": spark.createDataFrame(spans, "k int, lo double, hi double")}

    def call(text):
        function, arg, *distinct = text.split()
        return {"function": function, "args": {"function": "distinct", "args": arg} if distinct else [arg]}

    one, two = ("i", "p") if turned else ("p", "i")
    on = {"and": [{"gte": ["p.x", {"i": "lo"}]}, {"lt": ["p.x", {"i": "hi"}]}, *more.get("on", [])]}
    spec = {"data": [call(x) if " " in x else x for x in data], "from": [one, {"join": two, "on": on}], **{k: v for k, v in more.items() if k != "on"}}
    got, want = run_select(spec, tables), query_sql(tables, sql.replace("RANGE", RANGE))
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert [f.dataType for f in got.schema] == [f.dataType for f in want.schema]
    assert [c.replace("p.", "").replace("i.", "") for c in got.columns] == [c.replace("p.", "").replace("i.", "") for c in want.columns]
    spec["data"] = [x | {"as": f"c{k}"} if isinstance(x, dict) else x for k, x in enumerate(spec["data"])]
    assert [c for c in run_select(spec, tables).columns if c[0] == "c"] == [f"c{k}" for k, x in enumerate(data) if " " in x]


def test_a_page_reads_the_files_it_lies_in(spark, tmp_path):
    rows = spark.range(0, 20_000).select(F.pmod(F.xxhash64("id"), F.lit(5000)).alias("v"), "id")
    path = f"file://{tmp_path}/o"
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered.write_ordered(rows, ["v", "id"], path)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    want = [tuple(r) for r in rows.orderBy("v", "id").collect()]
    files = len(spark.read.parquet(f"{path}/rows").inputFiles())
    assert files == 4
    for offset, limit in ((0, 10), (9_990, 20), (19_995, 50), (20_000, 5), (4_000, 12_000), (7, 0)):
        page = ordered.read_page(spark, path, offset, limit)
        assert [tuple(r) for r in page.collect()] == want[offset : offset + limit]
    assert len(ordered.read_numbered(spark, path, 10_100, 10_110).inputFiles()) <= 2 + 1  # the index is one more
    assert ordered.read_numbered(spark, path, 19_000).count() == 1000


def test_sql_text_knows_its_own_tables_only(spark):
    one, two = spark.range(3).toDF("x"), spark.range(5).toDF("x")
    count = lambda df, **k: query_sql({"t": df}, "SELECT count(*) AS n FROM t" + k.pop("more", ""), **k).first().n
    assert count(one) == 3 and count(two, more=" WHERE x > :k", args={"k": 1}) == 3 and count(two, more=" WHERE x > ?", args=[2]) == 2
    for args in (None, {"k": 1}):
        with pytest.raises(Exception, match="TABLE_OR_VIEW_NOT_FOUND"):
            query_sql({"u": one}, "SELECT * FROM t", args)
    assert spark.catalog.listTables() == []
    with ThreadPoolExecutor(8) as pool:
        assert list(pool.map(lambda k: count((one, two)[k % 2]), range(40))) == [3, 5] * 20
    assert query_sql({"a b": one}, "/* WITH */ WITH `q` AS (SELECT * FROM `a b`) SELECT max(x) AS m FROM q").first().m == 2


TEXTS = [None, "", " a", "a ", "x\ny", "x\r\ny", "a\rb", 'q"uo"te', '""', '"', "a,b", "\\", "\\N", '\\"', 'back\\slash,"x"', "é\U0001f600", "\t", "  ", "null", "a\\\nb", "end\\", "#c", "\n", "\r"]


@pytest.mark.parametrize("kind", ["csv", "jsonl", "json", "parquet"])
def test_exports_keep_rows(spark, tmp_path, kind):
    """Texts of any kind, null keys, and chunks that the source no longer has."""
    rows = [(i, t, i * 1.5, [t, "x"]) for i, t in enumerate(TEXTS)] + [(None, "no key", 1.0, None), (None, None, None, [])]
    df = spark.createDataFrame(rows, "id long, t string, v double, a array<string>")
    path = f"file://{tmp_path}/{kind}"
    stats = export.export(df, path, kind, key="id", size=5).first()
    back = [tuple(r) for r in export.read_export(spark, path, kind, df.schema).collect()]
    assert sorted(back, key=repr) == sorted(rows, key=repr) and (stats.rows, stats.chunks) == (26, 6)
    export.export(df.where("id >= 20"), path, kind, key="id", size=5, after=19)
    assert export.read_export(spark, path, kind, df.schema).count() == 26  # a run that continues deletes nothing
    export.export(df.where("id < 7"), path, kind, key="id", size=5)
    assert sorted(r.id for r in export.read_export(spark, path, kind, df.schema).collect()) == list(range(7))
    assert sorted(r.chunk for r in export.manifest(spark, path).collect()) == [0, 1]
    export.export(df, path, kind, key="id", size=5)
    assert export.read_export(spark, path, kind, df.schema).count() == 26
