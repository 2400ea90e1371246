from datetime import datetime

import pytest
from pyspark.sql import functions as F

from gristmill.operators import checks, mapping, merge, profile, relational
from gristmill.sources import export
from gristmill.sources.database import scan_database
from gristmill.sources.state import Store, sync_status
from gristmill.sources.sync import SyncConfig, fetch_on_demand, sync, sync_all, sync_full, sync_incremental
from gristmill.sources.sync import register as sync_register
from gristmill.streaming.incremental import stream_into

#: Weather stations: number, office, place, time of the last reading, in service.
STATIONS = [
    (1, "north@weather.test", "Harbour mast", "2021-06-03T04:10:00", True),
    (2, "south@weather.test", "Quarry rim", "2021-06-04T05:20:00", False),
    (3, "north@weather.test", "Old mill", "2021-06-05T06:30:00", True),
    (4, "coast@weather.test", "Lighthouse", "2021-06-06T07:40:00", True),
    (5, "hills@weather.test", "Ridge hut", "2021-06-07T08:50:00", False),
]


def stations(spark, n=5, start=0):
    df = spark.createDataFrame(STATIONS[start:n], "id int, office string, place string, at string, active boolean")
    return df.withColumn("updated_at", F.to_timestamp("at")).drop("at")


# --- mapping ---------------------------------------------------------------------------------------


def test_names_and_positions(spark):
    schema = {"name": "t", "fields": {0: {"name": "id", "type": "integer", "alias": "user_id"}, 2: {"name": "name", "type": "string", "python_name": "full"}, 4: {"name": "email"}}, "total": 6}
    assert mapping.output_names(schema) == ["user_id", "Field_1", "full", "Field_3", "email", "Field_5"]
    assert mapping.output_names(schema, use_alias=False)[:3] == ["id", "Field_1", "name"]
    assert [mapping.resolve(schema, k) for k in ("id", "user_id", "full", 3)] == [0, 0, 2, 3]
    rows = spark.createDataFrame([(["7", "a", "n", "b", "e@x.y", None, "more"],), (["8"],)], "r array<string>")
    got = mapping.map_positions(rows, schema, "r", width=7)
    assert got.columns[-1] == "Field_6" and [tuple(x) for x in got.collect()] == [("7", "a", "n", "b", "e@x.y", None, "more"), ("8", *[None] * 6)]
    wide = spark.createDataFrame([(1, "Tide table", "t", "low", "high")], "_1 int, _2 string, _3 string, _4 string, _5 string")
    assert mapping.expand_star(wide, schema).columns == ["user_id", "Field_1", "full", "Field_3", "email"]
    assert [f.name for f in mapping.struct_of(schema)] == mapping.output_names(schema) and mapping.struct_of(schema)["user_id"].metadata["position"] == 0


def test_transformers(spark):
    schema = {"name": "t", "fields": {0: {"name": "n", "type": "integer"}, 1: {"name": "who", "transformer": F.upper}, 2: {"name": "d", "type": "date"}, 3: {"name": "j", "type": "json"}}, "total": 4}
    rows = spark.createDataFrame([("1", "buoy", "2020-02-29", '{"a":1}'), ("x", None, "2020-02-29T18:45:00", "{bad")], "n string, who string, d string, j string")
    a, b = mapping.transform_fields(rows, schema, keep_raw=True).collect()
    assert (a.n, a.n__raw, a.who, str(a.d), a.j) == (1, None, "BUOY", "2020-02-29", '{"a":1}')
    assert (b.n, b.n__raw, b.who, str(b.d), b.j, b.j__raw) == (None, "x", None, "2020-02-29", None, "{bad")


def test_storage_names_views_files(spark, tmp_path):
    schema = {"name": "t", "fields": {0: {"name": "a b"}, 1: {"name": "a-b"}, 2: {"name": "c", "remote_name": "far"}}, "total": 4}
    assert mapping.storage_columns(schema) == ["a_b", "a_b_1", "c", "Field_3"]
    stored = merge.stamp(spark.createDataFrame([(1, 2, 3, 4)], "a_b int, a_b_1 int, c int, Field_3 int"))
    assert mapping.named_view(stored, schema, "far_view").columns == ["a b", "a-b", "far", "Field_3", *mapping.BOOKKEEPING]
    assert spark.table("far_view").count() == 1
    (tmp_path / "x-schema.json").write_text('{"schemas": {"t": {"total_fields": 2, "fields": {"0": {"name": "id", "type": "integer"}}}}}')
    assert mapping.output_names(mapping.load_schemas(spark, f"file://{tmp_path}")["t"]) == ["id", "Field_1"]
    inferred = mapping.infer_schema(stations(spark), {2: "who"})
    assert [inferred["fields"][p]["name"] for p in range(5)] == ["id", "email", "who", "Field_3", "timestamp_4"]


# --- profiling -----------------------------------------------------------------------------------------


def test_profile(spark):
    df = spark.createDataFrame([(7, "oak", 61), (8, "elm", 12), (9, "elm", 33), (10, "elm", None)], "id int, tree string, height int")
    got = {r.column_name: r for r in profile.profile(df).collect()}
    assert (got["id"].null_count, got["id"].unique_count, got["id"].cardinality) == (0, 4, 1.0)
    assert (got["height"].null_count, got["height"].null_percentage) == (1, 25.0)
    assert tuple(got["tree"].top_values[0]) == ("elm", 3)
    numbers = {r.column_name: (r.min_value, r.max_value) for r in profile.profile_numeric(df).collect()}
    assert numbers == {"id": (7.0, 10.0), "height": (12.0, 61.0)}
    lengths = profile.profile_strings(spark.createDataFrame([("of",), ("moss",), ("lichen",)], "s string")).first()
    assert (lengths.min_length, lengths.max_length, round(lengths.avg_length, 2)) == (2, 6, 4.0)
    assert profile.profile(df.limit(0)).count() == 0
    broken = profile.introspect_all({"good": df, "bad": df}, lambda d: profile.profile(d) if d is df else d.select("nope"))
    assert all(not isinstance(x, str) for x in broken.values())
    assert isinstance(profile.introspect_all({"x": df}, lambda d: d.select("nope"))["x"], str)
    # One that fails while it runs leaves the others alone.
    mixed = profile.introspect_all({"good": df, "bad": df.withColumn("x", F.raise_error(F.lit("broken")))})
    assert isinstance(mixed["bad"], str) and "broken" in mixed["bad"] and mixed["good"].count() == 3
    with pytest.raises(KeyError):
        profile.introspect_all({"x": df}, lambda d: {}["a mistake"])


def test_inference(spark):
    row = ("907", "desk@ferry.test", "http://ferry.test/times", "0a1b2c3d-4e5f-6071-8293-a4b5c6d7e8f9", "+498912345", "2019-11-30", None, "73", "2019-11-30T23:05:00", "quay@ferry.test", "false", "20191130")
    df = spark.createDataFrame([row], ", ".join(f"c{i} string" for i in range(len(row))))
    got = {r.position: (r.inferred_type, r.inferred_name) for r in profile.classify_columns(df).collect()}
    assert [got[i][1] for i in range(12)] == ["id", "email", "url", "uuid", "phone", "date_5", "Field_6", "phone_7", "timestamp_8", "email_9", "Field_10", "Field_11"]
    assert got[6][0] == "unknown" and got[7][0] == "integer" and got[10][0] == "boolean" and got[5][0] == "date" and got[8][0] == "datetime"


def test_policy(spark):
    sizes = spark.createDataFrame([(730, False), (12, False), (41000, True), (41000, False), (350000, True)], "row_count long, has_update_time boolean")
    got = [(r.chunk_size, r.strategy, r.auto_sync, r.ttl, r.row_limit) for r in profile.ingest_policy(sizes).collect()]
    assert got == [(730, "full", True, 3600, 1460), (100, "full", True, 3600, 24), (5000, "incremental", True, 1800, 82000), (5000, "full", True, 1800, 82000), (10000, "incremental", False, 600, 700000)]
    flags = stations(spark).withColumn("deleted_on", F.lit(None).cast("date"))
    one = profile.ingest_policy(profile.policy_metadata(flags, "stations")).first()
    assert (one.table_name, one.row_count, one.incremental_field, one["where"]) == ("stations", 5, "updated_at", "`deleted_on` IS NULL AND `active` = true")
    assert flags.where(one["where"]).count() == 3 and profile.policy_metadata(spark.range(2), "r").first()["where"] is None


# --- checks --------------------------------------------------------------------------------------------


def test_match_ratio(spark):
    left = spark.createDataFrame([(1, "ash", None), (2, "birch", None), (3, "cedar", "x")], "id int, u string, v string")
    right = spark.createDataFrame([(1, "ash", None), (2, "Birch", None), (3, "cedar", "x")], "id int, name string, w string")
    one = checks.match_ratio(left, right, "id", "u", "name").first()
    assert (one.matches, round(one.match_ratio, 4), one.verdict, one.min_value, one.max_value, one.unique_count) == (2, 0.6667, "fail", "ash", "cedar", 3)
    report = {r.left_col: r for r in checks.validate_mapping(left, right, "id", {"v": "w", "gone": "w"}).collect()}
    assert report["v"].match_ratio == 1.0 and report["v"].null_count == 2 and report["v"].unique_count == 1 and "unknown column" in report["gone"].error


def test_constraints(spark):
    rows = [(1, "ab", None, -1.0), (1, "x" * 60, "e", 5.0), (None, "   ", "e", None), (4, None, "e", 1.0)]
    df = spark.createDataFrame(rows, "id int, username string, email string, balance double")
    spec = {"id": {"primary_key": True, "ge": 2}, "username": {"not_null": True, "min_length": 3, "max_length": 50, "not_blank": True, "unique": True}, "balance": {"ge": 0, "lt": 5, "validator": lambda c: c != 1.0}}
    got = {(r.column_name, r.rule): r.violations for r in checks.check_constraints(df, spec).collect()}
    assert got == {("id", "ge"): 2, ("id", "primary_key"): 2, ("username", "not_null"): 1, ("username", "min_length"): 1, ("username", "max_length"): 1, ("username", "not_blank"): 1, ("username", "unique"): 0, ("balance", "ge"): 1, ("balance", "lt"): 1, ("balance", "validator"): 1}
    assert checks.violating_rows(df, spec).count() == 4 and checks.check_constraints(df, {}).count() == 0
    assert [r.id for r in checks.orphans(df, df.where("id = 1"), "id", "id").collect()] == [4]


def test_drift(spark):
    old = spark.createDataFrame([(1, "a", 2)], "id int, name string, n int")
    new = spark.createDataFrame([(1, "x", "a", 2.0)], "id int, extra string, name string, n double")
    assert {r.field: r.change for r in checks.schema_drift(old, new).collect()} == {"extra": "added", "name": "moved", "n": "retyped"}
    assert checks.schema_drift(old, old).count() == 0
    prints = [checks.fingerprint(checks.field_mappings(x)).first()[0] for x in (old, new, old)]
    assert prints[0] == prints[2] != prints[1]


# --- merge ---------------------------------------------------------------------------------------------


def test_conflicts(spark):
    target = merge.stamp(spark.createDataFrame([(1, "basin")], "id int, name string"))
    batch = spark.createDataFrame([(1, "canal"), (2, "delta"), (2, "estuary"), (None, "n")], "id int, name string")
    names = lambda df: sorted((r.id or 0, r.name, r._sync_version) for r in df.collect())
    assert names(merge.bulk_insert(target, batch, "id", "REPLACE", "name")) == [(0, "n", 1), (1, "canal", 1), (2, "estuary", 1)]
    assert names(merge.bulk_insert(target, batch, "id", "IGNORE", "name")) == [(0, "n", 1), (1, "basin", 1), (2, "delta", 1)]
    with pytest.raises(ValueError):
        merge.bulk_insert(target, batch, "id", "FAIL")
    assert merge.bulk_insert(target, batch.where("name = 'delta'"), "id", "FAIL").count() == 2


def test_upsert(spark):
    target = merge.stamp(spark.createDataFrame([(1, "basin", "b"), (9, "zone", "z")], "id int, name string, code string"))
    batch = spark.createDataFrame([(1, "creek"), (2, "dam"), (2, "dyke")], "id int, name string")
    got = {r.id: (r.name, r.code, r._sync_version) for r in merge.upsert(target, batch, "id", "name").collect()}
    assert got == {1: ("creek", "b", 2), 9: ("zone", "z", 1), 2: ("dyke", None, 2)}
    assert tuple(merge.upsert_counts(target, batch, "id").first()) == (1, 2)
    assert tuple(merge.upsert_counts(target, batch.limit(0), "id").first()) == (0, 0)
    once = merge.upsert(target, batch, "id", "name")
    twice = merge.upsert(once, batch, "id", "name")
    data = lambda df: sorted(tuple(r) for r in df.select("id", "name").collect())
    assert data(once) == data(twice) and twice.where("id = 2").first()._sync_version == 4


def test_upsert_of_late_rows(spark):
    """With an order the later row stays, whichever batch brings it; without one the batch wins."""
    target = merge.stamp(spark.createDataFrame([(1, 50, "new"), (2, None, "bare"), (3, 7, "b")], "id int, at int, what string"))
    late = spark.createDataFrame([(1, 20, "old"), (2, 1, "dated"), (3, 7, "a")], "id int, at int, what string")
    rows = lambda df: sorted((r.id, r.at, r.what, r._sync_version) for r in df.collect())
    assert rows(merge.upsert(target, late, "id", "at")) == [(1, 50, "new", 2), (2, 1, "dated", 2), (3, 7, "b", 2)]
    assert rows(merge.upsert(target, late, "id")) == [(1, 20, "old", 2), (2, 1, "dated", 2), (3, 7, "a", 2)]


# --- sync ----------------------------------------------------------------------------------------------


def test_full_then_incremental(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    cfg = SyncConfig("stations", strategy="incremental", incremental_field="updated_at")
    first = sync(store, stations(spark, 3), cfg)
    assert (first["status"], first["fetched"], first["inserted"]) == ("completed", 3, 3)
    assert sync(store, stations(spark), cfg)["status"] == "skipped"
    second = sync(store, stations(spark), cfg, force=True)
    assert (second["fetched"], second["inserted"], second["updated"], second["row_count"]) == (2, 2, 0, 5)
    assert (second["min_id"], second["max_id"]) == ("1", "5")
    third = sync_incremental(store, stations(spark), cfg)
    assert third["fetched"] == 0 and store.version("stations") == 2
    state = store.state().first()
    assert (state.total_syncs, state.failed_syncs, state.checkpoint[:10]) == (3, 0, "2021-06-07")
    assert sync_status(store.state(), datetime(2000, 1, 1)).first().freshness == "fresh" and sync_status(store.state(), datetime(2200, 1, 1)).first().freshness == "stale"
    assert store.history(2).count() == 2
    with pytest.raises(ValueError):
        sync_incremental(store, stations(spark).drop("updated_at"), cfg)


def test_failure_keeps_the_snapshot(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    cfg = SyncConfig("stations", where="active = true", exclude=["office"])
    assert sync(store, stations(spark), cfg)["row_count"] == 3 and "office" not in store.read("stations").columns
    bad = sync(store, spark.createDataFrame([(1,)], "id int"), cfg, force=True)
    assert bad["status"] == "failed" and store.read("stations").count() == 3
    state = store.state().first()
    assert state.failed_syncs == 1 and state.last_error and state.status == "failed"
    assert sync_full(store, stations(spark), cfg, where="id > 1", dry_run=True)["fetched"] == 2
    results = sync_all(store, [(lambda: stations(spark), SyncConfig("a", limit=2, order_by="id")), (lambda: 1 / 0, SyncConfig("b")), (lambda: stations(spark), SyncConfig("c", disabled=True)), (lambda: stations(spark), SyncConfig("d", strategy="on-demand"))])
    assert [r["status"] for r in results] == ["completed", "failed", "disabled", "on_demand"] and store.read("a").count() == 2
    with pytest.raises(ValueError):
        SyncConfig("x", strategy="never")


def test_on_demand(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}")
    cfg = SyncConfig("stations", strategy="on_demand")
    assert [r.id for r in fetch_on_demand(store, stations(spark), cfg, id=2).collect()] == [2]
    fetch_on_demand(store, stations(spark), cfg, id__gte=2, active=True)
    assert sorted((r.id, r._is_partial) for r in store.read("stations").collect()) == [(2, True), (3, True), (4, True)]


def test_incremental_limit_misses_nothing(spark, tmp_path):
    """Rows beyond the limit come with later loads, also those that tie with the last one and those of small keys."""
    rows = spark.createDataFrame([(k, (9 - k) // 2) for k in range(10)], "id int, stamp int")
    store = Store(spark, f"file://{tmp_path}")
    cfg = SyncConfig("t", strategy="incremental", incremental_field="stamp", limit=3)
    seen = [sync(store, rows, cfg, force=True)["row_count"] for _ in range(4)]
    assert seen == [4, 8, 10, 10] and sorted(r.id for r in store.read("t").collect()) == list(range(10))


def test_register(spark, tmp_path):
    """Snapshot of all positions, recorded run, fields and view from one call."""
    store = Store(spark, f"file://{tmp_path}")
    schema = {"name": "tides", "fields": {0: {"name": "id", "type": "integer"}, 2: {"name": "high-mark", "type": "float", "remote_name": "mark"}}, "total": 4}
    rows = spark.createDataFrame([(["4", "a", "1.5", "x", "more"],), (["5", "b", None],), (["5", "c", "2.5"],)], "r array<string>").select(*(F.try_element_at("r", F.lit(i)).alias(f"_{i}") for i in range(1, 6)))
    view = sync_register(store, schema, rows, "id", view="tides_now")
    assert view.columns == ["id", "Field_1", "mark", "Field_3", "Field_4", *mapping.BOOKKEEPING] and spark.table("tides_now").count() == 2
    assert sorted((r.id, r.mark, r.Field_4) for r in view.collect()) == [(4, 1.5, "more"), (5, 2.5, None)]
    state = store.state().first()
    assert (state["table"], state.status, state.row_count, state.min_id, state.max_id) == ("tides", "completed", 2, "4", "5")
    assert spark.read.parquet(f"file://{tmp_path}/tides/fields").where("field = 'high_mark' AND position = 2").count() == 1


def test_read_with_schema_and_declared_relations(spark, tmp_path):
    schema = {"name": "berth", "fields": {0: {"name": "id", "type": "integer"}, 1: {"name": "quay_id", "type": "integer", "foreign_key": "quay.id"}}, "total": 2}
    spark.createDataFrame([("1", "7"), ("2", "8"), ("3", None)], "a string, b string").write.csv(f"file://{tmp_path}/berth", header=True)
    berths = mapping.read_with_schema(spark, f"file://{tmp_path}/berth", schema, "csv", header=True)
    assert dict(berths.dtypes) == {"id": "bigint", "quay_id": "bigint"}
    quays = spark.createDataFrame([(7, "east")], "id long, side string")
    up = relational.join_declared(berths, schema, {"quay": quays})
    assert {r.id: r.quay and r.quay.side for r in up.collect()} == {1: "east", 2: None, 3: None}
    down = relational.join_declared(quays, {"name": "quay", "fields": {0: {"name": "id"}, 1: {"name": "side"}}}, {"berth": berths}, {"berth": schema})
    assert [b.id for b in down.first().berth_list] == [1]


def test_database_scan(spark):
    url = "jdbc:derby:memory:harbour;create=true"
    driver = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(1, 101).select(F.col("id").cast("int").alias("ID"), (F.col("id") % 7).cast("int").alias("KIND"))
    rows.write.jdbc(url, "SHIPS", properties=driver)
    df = scan_database(spark, url, "SHIPS", key="ID", partitions=4, properties=driver)
    assert df.rdd.getNumPartitions() == 4 and sorted(map(tuple, df.collect())) == sorted(map(tuple, rows.collect()))
    assert scan_database(spark, url, "SHIPS", key="ID", where="KIND = 3", properties=driver).count() == rows.where("KIND = 3").count()
    assert scan_database(spark, url, "SHIPS", properties=driver).count() == 100 and scan_database(spark, url, "SHIPS", key="ID", where="KIND > 9", properties=driver).count() == 0


def test_stream(spark, tmp_path):
    rows = stations(spark).select("id", "place", "updated_at")
    rows.where("id <= 3").coalesce(1).write.parquet(f"file://{tmp_path}/in")
    store = Store(spark, f"file://{tmp_path}/store")
    go = lambda: stream_into(store, f"file://{tmp_path}/in", rows.schema, "u", "id", "updated_at", f"file://{tmp_path}/cp")
    assert go().count() == 3
    again = rows.where("id >= 3").withColumns({"place": F.lit("moved"), "updated_at": F.col("updated_at") + F.expr("INTERVAL 1 DAY")})
    again.coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    got = {r.id: (r.place, r._sync_version) for r in go().collect()}
    assert got == {1: ("Harbour mast", 1), 2: ("Quarry rim", 1), 3: ("moved", 2), 4: ("moved", 1), 5: ("moved", 1)}
    version = store.version("u")
    go()
    assert store.version("u") == version


def test_stream_of_late_files(spark, tmp_path):
    """Files written newest first: the latest row of each key stays, old snapshots go."""
    rows = spark.createDataFrame([(k % 4, k, f"r{k}") for k in range(40)], "id int, at int, what string")
    for start in (30, 20, 10, 0):
        rows.where(F.col("at").between(start, start + 9)).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    store = Store(spark, f"file://{tmp_path}/store")
    got = {r.id: (r.at, r.what, r._sync_version) for r in stream_into(store, f"file://{tmp_path}/in", rows.schema, "u", "id", "at", f"file://{tmp_path}/cp").collect()}
    assert got == {k: (36 + k, f"r{36 + k}", 10) for k in range(4)}
    assert len(list(tmp_path.glob("store/u/data/*"))) == 2 and len(list(tmp_path.glob("store/u/log/*.json"))) == 2


# --- export --------------------------------------------------------------------------------------------


@pytest.mark.parametrize("kind", ["jsonl", "json", "csv", "parquet"])
def test_export_resumes(spark, tmp_path, kind):
    rows = spark.range(1, 26).select("id", F.concat(F.lit('quo"te, '), "id").alias("name"), F.when(F.col("id") % 2 == 0, F.col("id") / 2).alias("half"))
    path = f"file://{tmp_path}/out"
    stats = export.export(rows.where("id <= 10"), path, kind, key="id", size=10).first()
    assert (stats.chunks, stats.rows) == (1, 10)
    stats = export.export(rows, path, kind, key="id", size=10).first()
    assert (stats.chunks, stats.rows) == (3, 25)
    assert sorted(map(tuple, export.read_export(spark, path, kind, rows.schema).collect())) == sorted(map(tuple, rows.collect()))
    assert export.export(rows, path, kind, key="id", size=10).first().rows == 25


@pytest.mark.parametrize("kind", ["jsonl", "json", "csv", "parquet"])
def test_export_sees_what_changed(spark, tmp_path, kind):
    """A new smallest key, rows added to a finished chunk and a changed row are exported; other chunks stay."""
    path = f"file://{tmp_path}/out"
    rows = spark.createDataFrame([(k, f"v{k}") for k in range(20, 40, 2)], "id int, v string")
    export.export(rows, path, kind, key="id", size=10)
    more = spark.createDataFrame([(3, "least"), (21, "within"), (38, "changed")], "id int, v string").unionByName(rows.where("id <> 38"))
    stats = export.export(more, path, kind, key="id", size=10).first()
    assert (stats.chunks, stats.rows) == (3, 12)
    assert sorted(map(tuple, export.read_export(spark, path, kind, rows.schema).collect())) == sorted(map(tuple, more.collect()))
    before = set(tmp_path.glob("out/**/part-*"))
    export.export(more, path, kind, key="id", size=10)
    assert set(tmp_path.glob("out/**/part-*")) == before


@pytest.mark.parametrize("kind", ["jsonl", "json", "csv", "parquet"])
def test_exported_rows_are_in_order(spark, tmp_path, kind):
    rows = spark.createDataFrame([(k, (k * 7) % 20) for k in range(20)], "id int, rank int").repartition(5)
    export.export(rows, f"file://{tmp_path}/out", kind, key="id", order_by=["rank"], size=100)
    got = [r.rank for r in export.read_export(spark, f"file://{tmp_path}/out", kind, rows.schema).coalesce(1).collect()]
    assert got == sorted(got)


def test_offset_chunks_over_several_ranges(spark):
    rows = spark.range(0, 3000).select(((F.col("id") * 7919) % 3000).alias("k"), F.concat(F.lit("row "), "id").alias("note")).repartition(6)
    keep = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled",)}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        chunked = export.offset_chunks(rows, ["k"], 70)
        got = chunked.collect()
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    assert len(got) == 3000 and all(r["_chunk"] == r.k // 70 for r in got) and {(r.k, r.note) for r in got} == {tuple(r) for r in rows.collect()}


def test_offset_chunks_gzip_cursor(spark, tmp_path):
    rows = spark.range(0, 100).select((F.col("id") * 3).alias("k"))
    got = {r["k"]: r["_chunk"] for r in export.offset_chunks(rows, ["k"], 30).collect()}
    assert got == {3 * i: i // 30 for i in range(100)}
    export.export(rows, f"file://{tmp_path}/g", "jsonl", order_by=["k"], size=50, after=149, gzip=True)
    assert export.read_export(spark, f"file://{tmp_path}/g", "jsonl", rows.schema).count() == 50 and list(tmp_path.glob("g/**/*.gz"))
    both = export.export_all({"a": rows, "b": rows}, f"file://{tmp_path}/all", "csv", key="k")
    assert all(not isinstance(x, str) for x in both.values())


def test_result_cache(spark, tmp_path):
    cache, calls = export.ResultCache(spark, f"file://{tmp_path}"), []

    def build():
        calls.append(1)
        return spark.range(3)

    request = {"method": "select", "params": {"from": "t", "data": ["id"]}}
    for _ in range(2):
        assert cache.result({"method": "update", "params": {}}, "t", build).count() == 3
    assert len(calls) == 2 and not list(tmp_path.iterdir())
    calls.clear()
    assert cache.result(request, "t", build).count() == 3 and cache.result(dict(reversed(request.items())), "t", build).count() == 3
    assert len(calls) == 1
    cache.clear("t")
    cache.result(request, "t", build)
    assert len(calls) == 2
    export.ResultCache(spark, f"file://{tmp_path}", ttl=0).result(request, "t", build)
    assert len(calls) == 3
    # Results out of date are deleted once their readers had time, and fresh ones stay.
    assert cache.sweep() == 0 and len(list(tmp_path.iterdir())) == 4
    assert export.ResultCache(spark, f"file://{tmp_path}", ttl=-1, grace=0).sweep() == 4
    assert [p.name for p in tmp_path.iterdir()] == ["entries"] and not list(tmp_path.glob("entries/*/*.parquet"))
    assert cache.result(request, "t", build).count() == 3 and cache.result(request, "t", build).count() == 3 and len(calls) == 4
