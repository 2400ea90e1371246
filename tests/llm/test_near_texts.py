import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from gristmill.llm import graph, jaccard

from . import brute


def edited(rng, words, share):
    out = list(words)
    for _ in range(max(1, int(share * len(out)))):
        k = rng.randrange(len(out))
        kind = rng.random()
        if kind < 0.4:
            out[k] = "new%d" % rng.randrange(10**6)
        elif kind < 0.7:
            del out[k]
        else:
            out.insert(k, "put%d" % rng.randrange(10**6))
        if not out:
            out = ["x"]
    return out


def corpus(seed):
    rng = random.Random(seed)
    texts = list(brute.ODD_TEXTS)
    line = "Licensed under the common license, version 2.0 of no year."
    for n in (3, 4, 5, 7, 9, 12, 20, 33, 60, 150, 400):
        for _ in range(6):
            base = [rng.choice(["the", "of", "in", "an"]) + str(rng.randrange(300)) for _ in range(n)]
            texts += [" ".join(base)] + [" ".join(edited(rng, base, rng.choice([0.003, 0.01, 0.02, 0.03]))) for _ in range(5)]
            chain = base
            for _ in range(4):
                chain = edited(rng, chain, 0.01)
                texts.append(" ".join(chain))
    texts += [line + "\n" + " ".join(f"w{rng.randrange(400)}" for _ in range(rng.randrange(1, 40))) for _ in range(60)]
    texts += [texts[30].upper(), texts[30] + " ", texts[31], texts[31]]
    rng.shuffle(texts)
    return [(3 * i + 1, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("words,percent", [(4, 85), (5, 80), (1, 90)])
def test_equals_brute_force(spark, words, percent):
    rows = corpus(words)
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows], "doc_id long, text string, k string, n int")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(df, words, percent).collect()}
    assert got == brute.near_texts(rows, words, percent)


@pytest.mark.parametrize("left,entries", ((1, 1), (1000, 300)))
def test_large_groups_are_dealt_over_cells(spark, monkeypatch, left, entries):
    """Keys of more than 3 sets, components of more than 400 elements and buckets of more than a few entries go the way of large groups."""
    for name, value in (("KEY_ROWS", 3), ("CELL_ELEMENTS", 400), ("LEFT_ROWS", left), ("LEFT_MARKS", left), ("HEADS", 2), ("BUCKET_ENTRIES", entries)):
        monkeypatch.setattr(jaccard, name, value)
    rng = random.Random(5)
    base = [f"w{k}" for k in range(120)]
    rows = [(i, " ".join(edited(rng, base, 0.05))) for i in range(40)] + corpus(9)[:150]
    rows = [(k, t) for k, (_, t) in enumerate(rows)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(df, 4, 85).collect()}
    assert got == brute.near_texts(rows)


def test_members_of_large_buckets(spark, monkeypatch):
    """Dealt over parts or not, buckets give the same members; one key has a third of all entries, and entries repeat."""
    rng = np.random.default_rng(8)
    key = np.where(rng.random(30_000) < 0.33, 5, rng.integers(0, 2**47, 30_000) * 2 + 1)
    key[rng.random(30_000) < 0.3] = rng.integers(6, 900)
    node = rng.integers(-(2**62), 2**62, 30_000)
    node[::3] = node[1::3]
    key[::6] = key[1::6]
    rows = []
    for part in np.array_split(np.arange(30_000), 40):
        for b in range(4):
            some = part[key[part] % 4 == b]
            rows.append((b, len(some), jaccard._six_bytes(key[some]), node[some].tobytes()))
    entries = spark.createDataFrame(rows, "bucket int, n long, keys binary, nodes binary").where("n > 0")
    want = {}
    for k, x in zip(key.tolist(), node.tolist(), strict=True):
        want.setdefault(k, set()).add(x)
    want = sorted((k, x, len(s)) for k, s in want.items() if len(s) > 1 for x in s)
    for most in (1 << 22, 2000, 700):
        monkeypatch.setattr(jaccard, "BUCKET_ENTRIES", most)
        assert sorted(tuple(r) for r in jaccard._members(entries).select("grp", "node", "size").collect()) == want


def test_parts_of_one_size_are_compared():
    """Every order of links must end in the components of the relation, whichever part is the largest meanwhile."""
    rng = np.random.default_rng(4)
    for _ in range(400):
        m = int(rng.integers(1, 14))
        related = np.triu(rng.random((m, m)) < rng.choice([0.05, 0.15, 0.3]), 1)
        related = related | related.T
        pairs = jaccard._joined(m, np.zeros(m, np.int64), lambda x, others, r=related: r[x, others])
        assert all(related[p] for p in pairs) and len(pairs) < m
        assert brute.components(range(m), pairs) == brute.components(range(m), list(zip(*np.nonzero(related), strict=True)))


def test_documents(spark, sf):
    df = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in df.collect()]
    want = brute.near_texts(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(df, 4, 85).collect()}
    assert got == want
    kept = jaccard.drop_near_copies(df)
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, c) in brute.near_texts(rows, 5, 80).items() if i == c}


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert jaccard.jaccard_classes(df).count() == 0
    text = "one two three four five six seven"
    null = spark.createDataFrame([(None, text), (8, text), (9, text), (None, None)], "doc_id long, text string")
    assert sorted(((r.doc_id or 0), r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(null).where("n_shingles > 0").collect()) == [(0, 3, 8), (8, 3, 8), (9, 3, 8)]


def test_null_ids_repeated_rows_and_shared_ids(spark):
    rng = random.Random(11)
    words = [[f"{c}{rng.randrange(10**6)}" for _ in range(80)] for c in "abcdef"]
    near = [" ".join([*w[:-1], "changed"]) for w in words]
    text = [" ".join(w) for w in words]
    rows = [
        (None, text[0], "x"),  # unique text without an id
        *[(None, None, "x"), (None, "", "y"), (7, " ", "x"), (7, " ", "x")],  # wordless
        *[(None, text[1], "x"), (None, text[1], "y"), (None, near[1], "x")],  # a class of null ids
        *[(None, text[2], "x"), (20, near[2], "x")],
        *[(30, text[3], "y"), (30, text[3], "x"), (30, text[3], "x"), (31, near[3], "x")],  # equal rows
        *[(40, text[4], "x"), (40, text[5], "x"), (41, near[4], "x"), (42, near[5], "x")],  # two texts of one id
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    classes = [tuple(r) for r in jaccard.jaccard_classes(df).collect()]
    assert len(classes) == len(rows)
    assert sorted((r for r in classes if r[0] is not None), key=str) == sorted([(7, 0, 7)] * 2 + [(20, 76, 20)] + [(30, 76, 30)] * 3 + [(31, 76, 30)] + [(40, 76, 40)] * 2 + [(41, 76, 40), (42, 76, 40)], key=str)
    for some in (df, df.orderBy(F.desc("source")).repartition(3)):
        kept = sorted((tuple(r) for r in jaccard.drop_near_copies(some).collect()), key=str)
        alone = [r for r in kept if r[1] in (text[1], near[1])]
        equal = [r for r in kept if r[0] == 30]
        assert len(alone) == 1 and len(equal) == 1
        assert sorted((r for r in kept if r not in alone + equal), key=str) == sorted([*rows[:5], (20, near[2], "x"), *rows[14:16]], key=str)


def test_similar_sets_always_share_a_key():
    rng = np.random.default_rng(3)
    for percent in (80, 85):
        for n in [*range(1, 60), 127, 128, 129, 300, 1000]:
            base = np.unique(rng.integers(0, 2**63, n, dtype=np.uint64))
            for _ in range(4):
                gone, new = rng.integers(0, max(1, n // 5) + 1, 2)
                other = np.unique(np.concatenate([base[gone:], rng.integers(0, 2**63, new, dtype=np.uint64)]))
                both = len(np.intersect1d(base, other))
                if both and 100 * both >= percent * (len(base) + len(other) - both):
                    assert len(np.intersect1d(jaccard.index_keys(base, percent), jaccard.index_keys(other, percent)))


@pytest.mark.parametrize("percent", (80, 85))
def test_greatest_difference_across_a_border_shares_a_key(percent):
    """Every pair of sizes on both sides of a band's border that differs by as much as a link may."""
    rng = np.random.default_rng(7)
    borders = [2**k for k in range(1, 8)]
    pairs = [(a, b, 20) for low in borders for a in range(low // 2, low) for b in range(low, a * 100 // percent + 1)]
    lost = []
    for a, b, seeds in [*pairs, (31, 32, 4000)]:
        shared = -(-percent * (a + b) // (100 + percent))
        if shared > a:
            continue
        for _ in range(seeds):
            every = rng.integers(0, 2**63, a + b - shared, dtype=np.uint64)
            keys = (jaccard.index_keys(np.sort(x), percent) for x in (every[:a], every[a - shared :]))
            if not len(np.intersect1d(*keys)):
                lost.append((a, b))
    assert not lost


@pytest.mark.parametrize("percent", (80, 85, 90))
def test_left_out_segments_never_exceed_what_must_agree(percent):
    for n in range(1, 700):
        for m in range(n, n * 100 // percent + 1):
            band = jaccard.band_of(n)
            weight = np.dot(jaccard.scheme(*band, percent), (1, 2))
            smallest = [-(-x * percent // 100) for x in (n, m)]
            own = jaccard.most_between(n + max(band[1], smallest[0]), n + n * 100 // percent, percent)
            other = jaccard.most_between(m + max(band[1], smallest[1]), m + min(band[2], m * 100 // percent), percent)
            most = jaccard.most_difference(n, m, percent)
            assert most <= min(own, other) and most < weight


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(1000 + i, 1001 + i) for i in range(120)] + [(5, 5)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in graph.components(df).collect()}
    want = brute.components({x for p in links for x in p}, links)
    assert got == {n: c for n, c in want.items() if any(n in p and p[0] != p[1] for p in links)}
    assert graph.components(df.limit(0)).count() == 0


def test_marks_never_overstate_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 500, n).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) for n in rng.integers(1, 400, 60)]
    i, j = (x.ravel() for x in np.meshgrid(np.arange(60), np.arange(60)))
    real = np.array([len(np.setxor1d(sets[a], sets[b])) for a, b in zip(i, j, strict=True)])
    for bits in (jaccard.NARROW, jaccard.WIDE):
        marks = jaccard.Marks([jaccard.parity_marks(s, bits).tobytes() for s in sets])
        assert (marks.least_difference(i, j) <= real).all()
