import math
import re

import numpy as np
import pytest

from gristmill.llm import negatives, queries

SCHEMA = "vec_id long, embedding array<float>, label int, grp string, score int"


def brute(rows, positives=5, many=3, window=(50, 95), scale=256):
    """Every anchor against every row, one by one, with Python's whole numbers."""
    fit = []
    for i, v, label in rows:
        if i is None or label is None or v is None or any(x is None or not math.isfinite(x) for x in v):
            continue
        fit.append((i, [math.floor(scale * float(x)) for x in v], label))
    out = set()
    for i, v, label in fit:
        if i % 50:
            continue
        scored = [(-sum(p * q for p, q in zip(v, w, strict=True)), j, other) for j, w, other in fit if len(w) == len(v)]
        near = sorted({(s, j) for s, j, other in scored if other == label and j != i})[:positives]
        for ps, p in near:
            ok = sorted({(s, j) for s, j, other in scored if other != label and window[0] * -ps <= 100 * -s <= window[1] * -ps})[:many]
            out |= {(i, p, k + 1, j, -ps, -s) for k, (s, j) in enumerate(ok)}
    return out


def mined(df, **options):
    rows = [tuple(r[c] for c in ("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) for r in negatives.hard_negatives(df, **options).collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def clustered(n, dim, seed=0, labels=4):
    """Vectors around centres whose labels mix, some copied."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(8, dim))
    rows = []
    for k in range(n):
        x = centres[rng.integers(8)] + rng.normal(size=dim) * rng.choice([0.0, 0.1, 0.5])
        rows.append((k, (x / np.linalg.norm(x)).astype("f4").tolist(), int(rng.integers(labels))))
    return rows


@pytest.mark.parametrize("sizes", [(2048, 2048, 256), (50, 3, 2)])
def test_against_brute_force(spark, monkeypatch, sizes):
    for name, v in zip(("BLOCK_ROWS", "ANCHOR_ROWS", "CHUNK"), sizes, strict=True):
        monkeypatch.setattr(negatives, name, v)
    rows = clustered(900, 12)
    rows += [(1000 + k, rows[50][1], k % 3) for k in range(150)]  # one vector again and again: ties
    nan, inf = float("nan"), float("inf")
    some = rows[0][1]
    odd = [None, [], [0.0] * 12, [nan, *some[1:]], [inf, *some[1:]], [None, *some[1:]], some[:5], some[:5], [3.0]]
    rows += [(50 * (40 + k), v, 1) for k, v in enumerate(odd)] + [(2501 + k, v, 1 + k % 2) for k, v in enumerate(odd)]
    rows += [(None, some, 1), (2600, some, None), (None, None, None), (-50, [-x for x in some], 1), (-51, some, 2)]
    rows += [rows[3], rows[3], (3, some, 0), (100, rows[7][1], 3)]  # rows again, and ids again with other vectors
    df = spark.createDataFrame([(*r, "x", 1) for r in rows], SCHEMA)
    data = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    assert mined(df) == brute(data) and len(brute(data)) > 100
    assert mined(df, positives=2, negatives=1, window=(0, 100)) == brute(data, 2, 1, (0, 100))


def test_large_components(spark):
    """Scores beyond the whole numbers of doubles stay exact; beyond a long the row takes no part."""
    rows = [(k, [float(x) for x in np.random.default_rng(k).integers(-300_000, 300_000, 4)], k % 2) for k in range(200)]
    df = spark.createDataFrame([(*r, "x", 1) for r in [*rows, (300, [1e30, 0.0, 0.0, 0.0], 0)]], SCHEMA)
    assert mined(df) == brute([(r.vec_id, r.embedding, r.label) for r in df.where("vec_id < 300").collect()])


def test_bounds_hold_and_filter():
    rng = np.random.default_rng(3)
    x = rng.integers(-200, 200, (400, 16))
    near = x[:40] + rng.integers(-3, 4, (40, 16))
    references = x[:8] / np.linalg.norm(x[:8], axis=1, keepdims=True)
    a, b = (negatives.angles_to(v.astype(float), references) for v in (near, x))
    low, high = negatives.score_bounds(a, np.linalg.norm(near, axis=1), b, np.linalg.norm(x, axis=1))
    exact = near @ x.T
    assert (low <= exact).all() and (exact <= high).all()
    # Vectors close to a reference direction have narrow windows.
    assert (high[:8] < exact[:8].max(1, keepdims=True)).mean() > 0.9
    equal = negatives.score_bounds(b, np.linalg.norm(x, axis=1), b, np.linalg.norm(x, axis=1))
    assert (np.diag(equal[0]) <= (x * x).sum(1)).all() and ((x * x).sum(1) <= np.diag(equal[1])).all()


def test_no_anchors_through_the_driver(spark):
    """Anchors are repeated for each deal of the blocks and listed by name: neither table is broadcast, however small Spark takes it for."""
    df = spark.createDataFrame([(*r, "x", 1) for r in clustered(300, 6)], SCHEMA)
    assert int(spark.conf.get("spark.sql.autoBroadcastJoinThreshold").rstrip("b")) >= 10 << 20
    plan = negatives.hard_negatives(df)._jdf.queryExecution().executedPlan().toString()
    joins = {tuple(re.findall(r"(\w+)#", line.split("]")[0])): line for line in plan.splitlines() if "Join" in line}
    assert "SortMergeJoin" in joins["dim", "salt"] and "SortMergeJoin" in joins["grp", "place"]


def test_no_rows_and_registered_query(spark, sf):
    assert mined(spark.createDataFrame([], SCHEMA)) == set()
    assert mined(spark.createDataFrame([(0, [1.0], 1, "x", 1)], SCHEMA)) == set()
    rows = [(r.vec_id, r.embedding, None if r.label is None else (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = queries.op13_hard_negatives(spark, sf).collect()
    assert {(r.anchor_id, r.positive_id, r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got} == brute(rows) and len(got) == len(brute(rows)) > 0
