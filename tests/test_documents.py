"""Parsed JSON, inference from values, and mergeable profiles."""

import numpy as np
from pyspark.sql import functions as F

from gristmill.functions import scalars as S
from gristmill.operators import documents, merge, profile
from gristmill.sources import sketches
from gristmill.sources.state import Store


def test_values_at_paths(spark):
    texts = ['{"a": 1, "b c": {"x": "y", "z": [1, 2.5]}, "d": null}', '{"a": 2.5, "e": true, "b c": {"x": null}}', "{bad", None, "[1]", "5", '{"a": "text"}', '{"it\'s": 3}']
    df = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "k int, t string")
    got = {r.k: (r.a, r.x, r.z, r.e, r.q) for r in documents.flattened(df, "t", {"a": (["a"], "float"), "x": (["b c", "x"], "string"), "z": (["b c", "z", 1], "float"), "e": (["e"], "boolean"), "q": (["it's"], "integer")}).collect()}
    none = (None,) * 5
    assert got == {0: (1.0, "y", 2.5, None, None), 1: (2.5, None, None, True, None), 2: none, 3: none, 4: none, 5: none, 6: none, 7: (None, None, None, None, 3)}
    assert [r.ok for r in df.select(S.convert("t", "variant").isNotNull().alias("ok")).collect()] == [True, True, False, False, True, True, True, True]


def test_paths_and_types(spark):
    texts = ['{"a": 1, "b": {"x": "y", "z": [1, 2.5]}, "d": null}', '{"a": 2.5, "e": true, "b": {"x": null}}', None, "{bad"]
    found = documents.json_paths(spark.createDataFrame([(t,) for t in texts], "t string"), "t")
    assert {(r.path, r.inferred_type, r.present) for r in found.collect()} == {("a", "float", 2), ("b.x", "string", 1), ("b.z", "array", 1), ("d", "unknown", 0), ("e", "boolean", 1)}
    for some in ([], ["[1]"], ["nope"], [None]):
        assert documents.json_paths(spark.createDataFrame([(t,) for t in some], "t string"), "t").count() == 0


def test_inference_by_pattern_is_what_casts_say(spark):
    """Each text alone: the kind by patterns and casts is the kind by casts."""
    texts = ["1", " 1 ", "+7", "-0", "99999999999999999999", "1.5", ".5", "5.", "1e5", "1E-3", "1d", "1f", "NaN", "nan", "Infinity", "-inf", "1,5", "0x1F", "", " ", "true", "False", "2024-01-31", "2024-02-30", "2024-01-31 10:00:00", "2024-01-31T10:00:00Z", "1 2", "--1", "1e", "e5", "١", "1L", "١.٥"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    c = F.col("t")
    for kind, spark_type in (("integer", "bigint"), ("float", "double")):
        rows = df.select("t", profile._fits(c, kind).alias("got"), c.try_cast(spark_type).isNotNull().alias("want")).collect()
        assert [r.t for r in rows if r.got != r.want] == []


def test_typed_columns_are_not_looked_at(spark):
    df = spark.sql("SELECT 1 AS a, 1.5D AS b, true AS c, DATE'2024-01-01' AS d, TIMESTAMP'2024-01-01 10:00:00' AS e, 1.50BD AS f, '7' AS g, CAST(NULL AS int) AS h, array(1) AS i")
    assert [r.inferred_type for r in profile.infer_types(df).orderBy("position").collect()] == ["integer", "float", "boolean", "date", "datetime", "float", "integer", "unknown", "string"]
    assert "try_cast" not in profile.infer_types(df.select("a", "b", "c", "d", "e"))._jdf.queryExecution().optimizedPlan().toString().lower()


def test_sketches_of_parts_and_whole(spark):
    rng = np.random.default_rng(1)
    rows = [(k, float(x), f"v{k % 700}", None if k % 3 else k) for k, x in enumerate(rng.normal(size=6000))]
    df = spark.createDataFrame(rows, "id long, x double, s string, some long")
    parts = [sketches.sketched(df.where(F.col("id") % 3 == k)) for k in range(3)]
    whole = {r.column_name: r for r in sketches.approximate_profile(df).collect()}
    joined = {r.column_name: r for r in sketches.merged(parts[0].unionByName(parts[1]).unionByName(parts[2])).collect()}
    values = np.sort([r[1] for r in rows])
    for found in (whole, joined):
        assert {c: (r["size"], r.null_count) for c, r in found.items()} == {"id": (6000, 0), "x": (6000, 0), "s": (6000, 0), "some": (6000, 4000)}
        for c, n in (("id", 6000), ("x", 6000), ("s", 700), ("some", 2000)):
            assert abs(found[c].unique_count - n) <= 0.03 * n
        assert found["s"].quantiles is None
        ranks = np.searchsorted(values, found["x"].quantiles) / 6000
        assert np.abs(ranks - [0, 0.25, 0.5, 0.75, 1]).max() <= 0.02
    empty = {r.column_name: (r["size"], r.unique_count, r.quantiles) for r in sketches.approximate_profile(df.limit(0)).collect()}
    assert empty["x"] == (0, 0, None)


def test_a_profile_reads_new_folders_only(spark, tmp_path):
    store = Store(spark, f"file://{tmp_path}/store")
    df = spark.range(0, 2000).select("id", (F.col("id") % 10).alias("v"))
    store.write("t", merge.stamp(df), key="id", buckets=8)
    first = {r.column_name: r.unique_count for r in sketches.profile_stored(store, "t").collect()}
    assert abs(first["id"] - 2000) <= 60 and first["v"] == 10 and set(first) == {"id", "v"}
    described = lambda: {r.folder for r in store.sketches("t", sketches.SKETCHES).collect()}
    known = described()
    assert known == set(store.files("t").values())
    done = store.merge("t", spark.range(5000, 5002).select("id", F.lit(99).cast("long").alias("v")), "id")
    again = {r.column_name: (r["size"], r.unique_count) for r in sketches.profile_stored(store, "t").collect()}
    assert again["v"] == (2002, 11) and len(described() - known) == len(done["changed"]) <= 2
    sketches.profile_stored(store, "t")
    assert len(list(tmp_path.glob("store/t/sketches/*"))) == 2
