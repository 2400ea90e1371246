import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from gristmill.functions import aggregates as A
from gristmill.functions import predicates as P
from gristmill.functions import scalars as S
from gristmill.operators import dml, relational
from gristmill.plans.select import default_order, query_sql, run_delete, run_insert, run_select, run_update


@pytest.fixture(scope="module")
def tables(spark):
    users = spark.createDataFrame([(1, "ash@park.test", True, 10.0), (2, "birch@park.test", False, None), (3, None, True, 30.0), (4, "Al_c", None, 5.0)], "id int, email string, active boolean, balance double")
    devices = spark.createDataFrame([(10, 1, "t7"), (11, 1, "t8"), (12, 2, "t9"), (13, None, "t0")], "id int, user_id int, mac string")
    return {"users": users, "devices": devices}


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_in_accepts_three_shapes(tables):
    sub = {"data": "user_id", "from": "devices"}
    for shape in ([*["id"], {"select": sub}], ["id", [sub]], ["id", [{"select": sub}]]):
        assert rows(run_select({"data": ["id"], "from": "users", "where": {"in": shape}}, tables)) == [(1,), (2,)]
    some = {"data": "user_id", "from": "devices", "where": {"gt": ["id", 11]}}
    for more, want in (({"gt": ["id", 10]}, []), ({"and": [{"gt": ["id", 10]}, {"lt": ["id", 13]}]}, [(3,), (4,)]), ({"gt": ["id", 99]}, [(1,), (2,), (3,), (4,)])):
        # Nulls in the subquery, none, no rows at all; alone and beside another predicate.
        spec = {"data": ["id"], "from": "users", "where": {"not": {"in": ["id", {"select": some | {"where": more}}]}}}
        assert rows(run_select(spec, tables)) == want
        assert rows(run_select(spec | {"where": {"and": [spec["where"], {"gt": ["id", 3]}]}}, tables)) == [w for w in want if w[0] > 3]
    mine = {"not": [{"in": ["u.balance", {"select": {"data": "id", "from": "devices"}}]}]}
    assert rows(run_select({"data": ["u.id"], "from": {"table": "users", "as": "u"}, "where": mine}, tables)) == [(3,), (4,)]
    # A null in the subquery makes NOT IN match nothing.
    assert rows(run_select({"data": ["id"], "from": "users", "where": {"not": [{"in": ["id", {"select": sub}]}]}}, tables)) == []
    for shape in (["id", 1, 3], ["id", [1, 3]]):
        assert rows(run_select({"data": ["id"], "from": "users", "where": {"not": {"in": shape}}}, tables)) == [(2,), (4,)]


def test_is_and_nulls(tables):
    def ids(where):
        return [r[0] for r in rows(run_select({"data": ["id"], "from": "users", "where": where}, tables))]

    assert ids({"is": ["active", True]}) == [1, 3] and ids({"is_not": ["active", True]}) == [2, 4]
    assert ids({"is": ["email", None]}) == [3] and ids({"is_not": ["email", None]}) == [1, 2, 4]
    assert ids({"like": ["email", "a%"]}) == [1] and ids({"ilike": ["email", "a%"]}) == [1, 4]
    assert ids({"and": []}) == [1, 2, 3, 4] and ids({"or": [{"eq": ["id", 1]}, {"gt": ["balance", 20]}]}) == [1, 3]


def test_devices_per_user(tables):
    spec = {
        "data": ["u.id", {"function": "count", "args": ["d.id"], "as": "n"}],
        "from": [{"table": "users", "as": "u"}, {"join": "devices", "as": "d", "how": "left", "on": {"eq": [{"u": "id"}, {"d": "user_id"}]}}],
        "group_by": ["u.id"], "order_by": ["n", "DESC"], "limit": 2,
    }
    assert [tuple(r) for r in run_select(spec, tables).collect()][0] == (1, 2)
    spec |= {"having": {"gt": [{"function": "count", "args": ["d.id"]}, 0]}, "limit": None}
    assert rows(run_select(spec, tables)) == [(1, 2), (2, 1)]


def test_order_and_default_order(tables):
    assert [r[0] for r in run_select({"data": ["id"], "from": "users", "order_by": ["balance", "DESC"]}, tables).collect()] == [2, 3, 1, 4]
    assert [r[0] for r in run_select({"data": ["id"], "from": "users", "order_by": "balance"}, tables).collect()] == [4, 1, 3, 2]
    plain = {"data": ["id"], "from": "users", "limit": 2}
    assert default_order(plain) == ["id"] and default_order(plain | {"data": ["*"]}) == ["id"]
    for other in ({"data": ["email"]}, {"group_by": "id"}, {"order_by": "email"}, {"data": [{"function": "count", "args": ["*"]}, "id"]}, {"limit": None}, {"from": [{"table": "users"}, {"join": "devices"}]}, {"from": [{"select": {}}]}):
        assert default_order(plain | other) == []
    assert [r[0] for r in run_select(plain | {"offset": 1}, tables).collect()] == [2, 3]


def test_functions(tables, spark):
    one = spark.range(1)
    assert one.select(S.regexp_replace_first(F.lit("aXbX"), "X", "-").alias("a"), S.regexp_replace_first(F.lit("ab ab"), "(a)(b)", r"\2\1").alias("b")).first() == ("a-bX", "ba ab")
    assert one.select(S.div(F.lit(-7), F.lit(2), integers=True).alias("a"), S.mod(F.lit(-7), F.lit(3)).alias("b"), S.div(F.lit(7), F.lit(2)).alias("c")).first() == (-3, -1, 3.5)
    u = tables["users"]
    assert u.agg(A.array_agg("balance").alias("x")).first().x == [5.0, 10.0, 30.0, None]
    assert u.agg(A.string_agg("email", ",").alias("x")).first().x == "Al_c,ash@park.test,birch@park.test"
    assert u.agg(A.count_distinct("active", "balance").alias("n")).first().n == 4
    assert u.where(P.contains_text("email", "_c")).count() == 2 and u.where(~P.lookup_filter(id__lt=3, email__isnull=False)).count() == 2
    assert rows(u.where(P.live_rows(u)).select("id")) == [(1,), (3,)]
    with pytest.raises(AnalysisException):
        run_select({"data": [{"function": "no_such", "args": "id", "as": "x"}], "from": "users"}, tables)
    assert run_select({"data": [{"function": "concat", "args": ["email", "!"], "as": "x"}], "from": "users", "where": {"eq": ["id", 1]}}, tables).first().x == "ash@park.test!"


def test_dml(tables):
    new, back = run_insert({"into": "devices", "columns": ["id", "mac"], "values": [[20, "x"], [21, "y"]], "returning": ["id"]}, tables)
    assert new.count() == 6 and rows(back) == [(20,), (21,)] and new.where("id = 20").first().user_id is None
    new, back = run_update({"table": "users", "set": {"active": False, "balance": {"add": ["balance", {"lit": 1}]}}, "where": {"gt": ["balance", 7]}, "returning": ["id", "balance"]}, tables)
    assert rows(back) == [(1, 11.0), (3, 31.0)] and new.where("id = 2").first().balance is None and new.where("NOT active").count() == 3
    new, back = run_delete({"from": "users", "where": {"gt": ["balance", 7]}, "returning": "id"}, tables)
    assert rows(new.select("id")) == [(2,), (4,)] and rows(back) == [(1,), (3,)]
    empty, removed = dml.truncate(tables["users"])
    assert empty.count() == 0 and removed.first().removed == 4


def test_sql_text(tables):
    assert query_sql(tables, "SELECT count(*) AS n FROM {users} WHERE active").first().n == 2
    assert query_sql({"users": tables["users"]}, "SELECT id FROM users WHERE id > :x", {"x": 3}).first().id == 4
    with pytest.raises(AnalysisException):
        query_sql({"users": tables["users"]}, "SELECT * FROM no_such_table", {"x": 1})


def test_relations_and_pages(tables):
    up = relational.join_related(tables["devices"], tables["users"], "user_id", "id", "user")
    assert {r.id: r.user and r.user.email for r in up.collect()} == {10: "ash@park.test", 11: "ash@park.test", 12: "birch@park.test", 13: None}
    down = relational.join_related(tables["users"], tables["devices"], "id", "user_id", "devices", many=True)
    assert {r.id: [d.id for d in r.devices or []] for r in down.collect()} == {1: [10, 11], 2: [12], 3: [], 4: []}
    d = tables["devices"]
    assert [r.id for r in relational.keyset_page(d, "id", 10, 2).collect()] == [11, 12] and [r.id for r in relational.page(d, ["id"], 1, 2).collect()] == [11, 12]
    assert relational.scan_since(d, "id", 12).count() == 1 and relational.scan_since(d, "id", 12, inclusive=True).count() == 2
    assert relational.pick_fields(d, ["id", "mac", "no"], ["mac"]).columns == ["id"] and relational.sample_rows(d, 2).count() == 2
