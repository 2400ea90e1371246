import numpy as np
import pytest

from gristmill.llm import pivots, queries

from . import brute

SCHEMA = "vec_id long, embedding array<float>, label int, copies int, near string, root long"


def check(spark, rows):
    df = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    data = [(r.vec_id, r.embedding, r.label) for r in df.collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in pivots.near_vectors(df).collect()}
    assert got == brute.near_vectors(data)


def test_embeddings(spark, sf):
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id, r.kept) for r in queries.op1_pivot_near_dedup(spark, sf).collect()}
    assert got == brute.near_vectors(rows)


def test_odd_vectors_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(pivots, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(4)
    rows, k = [], 0
    centres = rng.normal(size=(12, 24))
    for c in centres:
        for _ in range(int(rng.integers(1, 30))):
            k += 1
            rows.append((k, (c + rng.normal(size=24) * rng.choice([0.05, 0.15, 0.3])).astype("f4").tolist(), int(rng.integers(0, 2))))
    nan, inf = float("nan"), float("inf")
    base = rows[0][1]
    for v in (None, [], [0.0] * 24, [nan] + base[1:], [inf] + base[1:], [None] + base[1:], base, base, [2 * x for x in base], base[:5], base[:5], [1.0]):
        k += 1
        rows.append((k, v, rows[0][2]))
    rows += [(k + 1, base, None), (k + 2, base, None)]
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(3, [1.0, 0.0], 1), (2, [1.0, 0.1], 1), (1, [0.0, 1.0], 1)])
    check(spark, [(9, [1.0, 2.0], 1)])
    null = spark.createDataFrame([(None, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (4, [1.0, 0.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted(((r.vec_id or 0), r.n_links) for r in pivots.near_vectors(null).collect()) == [(0, 0), (0, 0), (4, 0)]
    check(spark, [])
    # Two rows of one id are two vectors: each has its own links.
    twice = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.1], 1), (3, [0.1, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    assert sorted((r.vec_id, r.n_links, r.component_id) for r in pivots.near_vectors(twice).collect()) == [(1, 1, 1), (1, 1, 1), (2, 1, 1), (3, 1, 1)]


def unit(a):
    return a / np.linalg.norm(a, axis=1, keepdims=True)


def cone(rng, n, mean, dim=64):
    """Unit vectors whose cosines with each other are `mean` on average."""
    axis = np.eye(dim)[:1]
    off = rng.normal(size=(n, dim))
    off[:, 0] = 0
    return np.sqrt(mean) * axis + np.sqrt(1 - mean) * unit(off)


@pytest.mark.parametrize("mean", [0, 0.5, 0.7, 0.85])
@pytest.mark.parametrize("n", [1000, 10**6, 10**7])
def test_recall_at_the_threshold(n, mean):
    """Pairs at exactly the threshold are candidates of some list at every index size, also where all vectors share a direction."""
    rng = np.random.default_rng(0)
    most = pivots.pivots_for(n)
    index = pivots.index_of(cone(rng, min(pivots.SAMPLE_PER_PIVOT * most, pivots.SAMPLE_ROWS), mean), most, 0.93)
    assert len(index.points) == most
    x = cone(rng, 1500, mean)
    for noise in (rng.normal(size=x.shape), cone(rng, len(x), mean)):
        y = 0.93 * x + np.sqrt(1 - 0.93**2) * unit(noise - (noise * x).sum(1, keepdims=True) * x)
        met = 0
        for p, q in zip(index.order(x), index.order(y), strict=True):
            lists = [set(np.sort(v)[: max(1, index.many - index.shared + 1)].tolist()) for v in (p, q)]
            both = sorted(lists[0] & lists[1])
            met += bool(both) and bool(pivots.candidates(np.stack([p, q]), both[0], index.shared, index.agreement)[0, 1])
        assert met / len(x) >= 0.95


def test_links_on_a_table_with_a_common_direction(spark):
    """Chains of vectors around the threshold in a narrow cone, with near and exact copies, against brute force: recall 0.95 and no false link."""
    rng = np.random.default_rng(5)
    x = cone(rng, 400, 0.6, 32)
    rows = []
    for v in x:
        for c in rng.choice([0.9, 0.925, 0.935, 0.95, 0.99, 1.0], rng.integers(0, 4)):
            off = unit(rng.normal(size=(1, 32)))[0]
            off = off - (off @ v) * v
            rows.append(c * v + np.sqrt(1 - c * c) * off / np.linalg.norm(off))
        rows.append(v)
    data = [(k, v.astype("f4").tolist(), int(k % 2)) for k, v in enumerate(rows)]
    got = {r.vec_id: r.n_links for r in pivots.near_vectors(spark.createDataFrame(data, "vec_id long, embedding array<float>, label int")).collect()}
    want = {i: n for i, (n, _, _) in brute.near_vectors(data).items()}
    assert sum(want.values()) > 100 and all(got[i] <= want[i] for i in want)
    assert sum(got.values()) >= 0.95 * sum(want.values())


def test_a_mass_of_near_copies_takes_few_pivots():
    rng = np.random.default_rng(6)
    x = unit(np.concatenate([rng.normal(size=(3000, 32)), rng.normal(size=(1, 32)) + 0.01 * rng.normal(size=(3000, 32))]))
    index = pivots.index_of(rng.permutation(x), 256, 0.93)
    mass = unit(x[-1:] - index.mean)[0]
    assert len(index.points) == 256 and (index.points @ mass > 0.9).sum() <= 3


def test_the_order_of_pivots_counts():
    """Equal sets of pivots in opposite orders agree less than in the same order; far orders are no candidates."""
    same = np.arange(12)
    assert pivots.candidates(np.stack([same, same]), 0, 4, 150)[0, 1]
    few = np.concatenate([[0, 1, 2, 3], np.arange(20, 28)])
    last = np.concatenate([np.arange(40, 48), [3, 2, 1, 0]])
    assert not pivots.candidates(np.stack([few, last]), 0, 4, 150)[0, 1] and pivots.candidates(np.stack([few, few]), 0, 4, 150)[0, 1]
    shared, agreement = pivots.alike(np.stack([few, few]), np.stack([few, last]))
    assert shared.tolist() == [12, 4] and agreement[0] == sum(k * k for k in range(13)) > agreement[1] == 12 * 1 + 11 * 2 + 10 * 3 + 9 * 4


def test_pivots_grow_with_the_vectors():
    assert [pivots.pivots_for(n) for n in (0, 1, 65536, 65537, 10**6, 10**7, 10**9)] == [256, 256, 256, 512, 1024, 4096, 16384]
