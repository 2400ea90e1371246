"""Commit log, hash buckets, layout and history of stored tables."""

import threading
from concurrent.futures import ThreadPoolExecutor
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from gristmill.operators import merge
from gristmill.sources import state
from gristmill.sources.commits import CommitLog, Conflict
from gristmill.sources.state import Store
from gristmill.streaming.incremental import stream_into

SCHEMA = "id long, at long, what string"


@pytest.fixture
def store(spark, tmp_path):
    return Store(spark, f"file://{tmp_path}/store")


def rows(spark, keys, at=1, what="x"):
    return spark.createDataFrame([(k, at, what) for k in keys], SCHEMA)


def filled(store, spark, n=200, buckets=16):
    store.write("t", merge.stamp(rows(spark, range(n))), key="id", buckets=buckets)
    return store


def content(store, table="t"):
    return {r.id: (r.at, r.what, r._sync_version) for r in store.read(table).collect()}


def test_a_merge_rewrites_the_buckets_of_its_rows(spark, store, tmp_path):
    filled(store, spark)
    before = store.files("t")
    assert len(before) == 16
    done = store.merge("t", rows(spark, [3, 3, 500], 2, "new"), "id", "at", counted=True)
    after = store.files("t")
    assert {b for b in after if after[b] != before[b]} == set(done["changed"]) and len(done["changed"]) <= 2
    assert (done["inserted"], done["updated"]) == (1, 2)
    want = {k: (1, "x", 1) for k in range(200)} | {3: (2, "new", 3), 500: (2, "new", 1)}
    assert content(store) == want
    # An older version is still there; its folders go when it is forgotten.
    assert store.read("t", 1).count() == 200 and store.read("t").count() == 201
    store.vacuum("t", 1)
    assert content(store) == want and [r.version for r in store.commits("t").collect()] == [2]
    left = {str(p.relative_to(tmp_path / "store/t")) for p in tmp_path.glob("store/t/data/*/_bucket=*")}
    assert left == set(after.values())
    # No rows, null keys, and a first batch that creates the table.
    assert store.merge("t", rows(spark, []), "id", "at")["changed"] == [] and store.read("t").count() == 201
    store.merge("t", rows(spark, [None, None], 5), "id", "at")
    assert store.read("t").where("id IS NULL").count() == 2 and store.read("t").count() == 203
    assert store.merge("new", rows(spark, [1, 2]), "id", "at", counted=True, buckets=4)["inserted"] == 2 and store.read("new").count() == 2


def test_layout_stays_and_scans_skip(spark, store):
    df = spark.range(0, 50_000).select(F.pmod(F.xxhash64("id"), F.lit(10**6)).alias("id"), F.lit(1).alias("at"), F.col("id").cast("string").alias("what")).dropDuplicates(["id"])
    store.write("t", merge.stamp(df), key="id", cluster_by=["id"], bloom=["what"])
    scan = store.read("t").where("id BETWEEN 1000 AND 1100")
    found = scan.collect()
    read = scan._jdf.queryExecution().executedPlan().collectLeaves().head().metrics().apply("numOutputRows").value()
    assert len(found) > 0 and read < 0.5 * df.count()
    store.merge("t", rows(spark, [found[0].id], 2, "new"), "id", "at")
    assert store._log("t").last()[1]["cluster_by"] == ["id"] and store.read("t").where("what = 'new'").count() == 1


@pytest.mark.parametrize("buckets", [0, 16])
def test_merges_at_the_same_time_all_survive(spark, store, buckets):
    filled(store, spark, 50, buckets)
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda k: store.merge("t", rows(spark, [k, 1000 + k, 7], 2 + k, f"by {k}"), "id", "at"), range(4)))
    got = content(store)
    assert store.version("t") == 5 and len(got) == 54
    assert all(got[1000 + k] == (2 + k, f"by {k}", 1) for k in range(4))
    assert got[7] == (5, "by 3", 5)


def test_a_late_write_sees_that_it_must_begin_again(spark, store):
    filled(store, spark, 5, 0)
    store.write("t", merge.stamp(rows(spark, [1])), base=1)
    with pytest.raises(Conflict):
        store.write("t", merge.stamp(rows(spark, [2])), base=1)
    assert store.version("t") == 2 and set(content(store)) == {1}
    seen = []

    def build(old):
        seen.append(old.count())
        if len(seen) == 1:
            store.write("t", merge.stamp(rows(spark, [1, 2, 3])))
        return old.where("id <> 1")

    assert store.update("t", build) == 4 and seen == [1, 3] and set(content(store)) == {2, 3}


def test_numbers_are_taken_once(spark, tmp_path):
    log = CommitLog(spark, f"file://{tmp_path}/log")
    assert log.last() == (0, None)
    taken, start = [], threading.Barrier(8)

    def one(k):
        start.wait()
        taken.append((k, log.append({"by": k})))

    threads = [threading.Thread(target=one, args=(k,)) for k in range(8)]
    [x.start() for x in threads]
    [x.join() for x in threads]
    assert sorted(n for _, n in taken) == list(range(1, 9))
    assert all(log.entry(n)["by"] == k for k, n in taken) and not log.commit(3, {}) and log.entry(99) is None
    assert len(list(tmp_path.glob("log/0*.json"))) == 8


def test_a_long_history_is_few_files(spark, store, tmp_path, monkeypatch):
    monkeypatch.setattr(state, "COMPACT_RUNS", 50)
    now = datetime(2024, 1, 1, tzinfo=timezone.utc)
    runs = [dict(table=f"t{k % 3}", status="failed" if k % 10 == 0 else "completed", started_at=now + timedelta(minutes=k), finished_at=now + timedelta(minutes=k, seconds=5), checkpoint=str(k), row_count=k, error="broken" if k % 10 == 0 else None) for k in range(330)]
    for r in runs:
        store.record(**r)
    files = [p for p in tmp_path.glob("store/_history/**/*") if p.is_file() and not p.name.endswith(".crc")]
    assert len(files) < 110
    assert store.runs().count() == 330 and [r.checkpoint for r in store.history(3).collect()] == ["329", "328", "327"]
    for r in store.state().collect():
        own = [x for x in runs if x["table"] == r.table]
        done = [x for x in own if x["status"] == "completed"]
        assert (r.total_syncs, r.failed_syncs, r.last_checkpoint, r.row_count) == (len(done), len(own) - len(done), done[-1]["checkpoint"], own[-1]["row_count"])
        assert r.started_at.timestamp() == own[-1]["started_at"].timestamp()


def test_a_bucketed_stream(spark, store, tmp_path):
    data = spark.createDataFrame([(k % 40, k, f"r{k}") for k in range(400)], "id long, at long, what string")
    for start in (300, 0, 200, 100):
        data.where(F.col("at").between(start, start + 99)).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
    got = stream_into(store, f"file://{tmp_path}/in", data.schema, "u", "id", "at", f"file://{tmp_path}/cp", buckets=4)
    assert {r.id: (r.at, r._sync_version) for r in got.collect()} == {k: (360 + k, 10) for k in range(40)}
    assert store.last_batch("u") == 3 and len(store.files("u")) == 4
