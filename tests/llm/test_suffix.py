import hashlib
import io
import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from gristmill.llm import induced, queries, suffix

from . import brute


@pytest.mark.parametrize("batch,short,memory", [(1 << 15, 1 << 19, 1 << 30), (7, 2, 0), (64, 2, 0), (1 << 15, 2, 1 << 30)])
def test_suffix_array(monkeypatch, batch, short, memory):
    """Order and common prefixes against sorting: in one go, by recursion, in small batches, with every array on disk."""
    for name, value in (("BATCH", batch), ("SHORT", short), ("SYMBOLS", 5 if batch == 7 else 1024)):
        monkeypatch.setattr(induced, name, value)
    rng = np.random.default_rng(1)
    for _ in range(150):
        n, k, reach = int(rng.integers(0, 90)), int(rng.integers(1, 6)), int(rng.integers(1, 90))
        text = np.append(rng.integers(0, k, n) + 1, 0).astype(np.uint16)
        with induced.Disk(memory) as disk:
            order, shared = map(np.array, induced.suffix_array(text, int(text.max()) + 1, reach, disk))
        raw = text.tolist()
        cut = [tuple(raw[i : i + reach]) for i in order]
        assert sorted(order.tolist()) == list(range(len(text))) and cut == sorted(cut)
        for i in range(1, len(cut)):
            same = next((j for j, (a, b) in enumerate(zip(cut[i - 1], cut[i], strict=False)) if a != b), min(len(cut[i - 1]), len(cut[i])))
            assert shared[i] == same


def test_a_shard_far_larger_than_its_memory():
    """Windows of 400 kB with 64 kB of arrays in memory give the same runs as with all of them there."""
    rng = np.random.default_rng(2)
    stock = rng.integers(97, 103, 20_000).astype(np.uint8)
    size = rng.integers(50, 90, 6000)
    at = rng.integers(0, len(stock) - 100, len(size))
    about = np.zeros(len(size), suffix._WINDOW)
    about["id"], about["low"] = np.arange(len(size)), rng.integers(0, 10**6, len(size))
    about["high"] = about["low"] + rng.integers(0, 10, len(size))
    raw = b"".join(stock[a : a + n].tobytes() for a, n in zip(at, size, strict=True))
    found = [np.concatenate(list(suffix.window_runs(io.BytesIO(raw), size, about, 50, memory))) for memory in (1 << 30, 1 << 16)]
    assert len(found[0]) and (found[0] == found[1]).all()
    least = {}
    for a, n, low in zip(at.tolist(), size.tolist(), about["low"].tolist(), strict=True):
        for i in range(a, a + n - 49):
            key = stock[i : i + 50].tobytes()
            least[key] = min(least.get(key, low), low)
    want = {(w, i): v for w, (a, n) in enumerate(zip(at.tolist(), size.tolist(), strict=True)) for i in range(n - 49) if (v := least[stock[a + i : a + i + 50].tobytes()]) < about["high"][w]}
    assert {(int(r["id"]), i): int(r["least"]) for r in found[0] for i in range(r["a"], r["b"] + 1)} == want


def digest(df, width=50):
    rows = suffix.remove_repeats(df, width).collect()
    out = {}
    for r in rows:
        spans = [(s.a, s.b) for s in r.spans or []]
        out[r.doc_id] = (r.n_bytes, sum(b - a for a, b in spans), len(spans), hashlib.sha256(r.kept).hexdigest())
    assert len(out) == len(rows)
    return out


@pytest.mark.parametrize("width", [50, 7])
def test_equals_brute_force(spark, width):
    rng = random.Random(width)
    word = lambda: rng.choice(["the ", "of ", "é", "ing ", "a", "\n", "漢 "])
    parts = ["".join(word() for _ in range(rng.randrange(10, 60))) for _ in range(12)] + ["ab" * 60, "x" * 200]
    texts = ["".join(rng.choice(parts) if rng.random() < 0.4 else "".join(word() for _ in range(20)) for _ in range(rng.randrange(1, 6))) for _ in range(60)]
    texts += [*brute.ODD_TEXTS, texts[0], texts[3], texts[3], "y" * 49, "y" * 50, "y" * 51, texts[5][:-1]]
    rng.shuffle(texts)
    rows = [(5 * i - 40, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame([(*r, [1], "k") for r in rows], "doc_id long, text string, spans array<int>, keys string")
    assert digest(df, width) == brute.repeated_bytes(rows, width)
    null = spark.createDataFrame([(None, texts[0]), (None, texts[0])], "doc_id long, text string")
    got = suffix.remove_repeats(df.select("doc_id", "text").limit(3).unionByName(null), width).where("doc_id IS NULL").collect()
    assert len(got) == 2 and all(r.spans is None and r.kept == (texts[0] or "").encode() for r in got)


def test_documents(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in queries.op3_suffix_dedup(spark, sf).collect()}
    assert got == brute.repeated_bytes(rows)


def test_cut_repeats(spark):
    passage = "é".join(f"passage {i}" for i in range(12))
    df = spark.createDataFrame([(1, "first " + passage, "u"), (2, "zé" + passage + "é end", "v"), (3, None, "w"), (3, None, "w")], "doc_id long, text string, spans string")
    got = suffix.cut_repeats(df, 50)
    assert got.columns == ["doc_id", "text", "spans"]
    by = {r.doc_id: r.text for r in got.collect()}
    assert by[1] == "first " + passage and passage[10:60] not in by[2] and by[2].startswith("z") and by[2].endswith(" end") and by[3] is None
    assert got.count() == 4 and suffix.cut_repeats(df.limit(0), 50).where(F.lit(True)).count() == 0


def brute_rows(rows, width):
    """(id, text, bytes removed, bytes left): strings that also start in a row of a smaller id; rows of one id don't count for each other."""
    raws = [(i, (t or "").encode()) for i, t in rows]
    starts = {}
    for i, raw in raws:
        for k in range(len(raw) - width + 1):
            s = raw[k : k + width]
            starts[s] = min(starts.get(s, i), i)
    out = []
    for (i, t), (_, raw) in zip(rows, raws, strict=True):
        gone = bytearray(len(raw))
        for k in range(len(raw) - width + 1):
            if starts[raw[k : k + width]] < i:
                gone[k : k + width] = b"\1" * width
        out.append((i, t, sum(gone), bytes(b for b, g in zip(raw, gone, strict=True) if not g)))
    return out


def test_an_id_with_two_texts(spark):
    """Each text of an id has its own spans; the short one is no shorter for what the long one repeats."""
    one, two = ("".join(chr(97 + (k * k * m + k) % 26) for k in range(210)) for m in (3, 7))
    rows = [(1, one), (2, f"head {one} tail"), (2, "short"), (3, one + two), (3, f"x{one}"), (3, f"x{one}"), (3, None), (4, two), (4, one), (5, f"é{two}é"), (6, two[:60])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = suffix.remove_repeats(docs, 50).selectExpr("doc_id", "aggregate(spans, 0L, (n, s) -> n + s.b - s.a) AS gone", "kept").collect()
    assert sorted((r.doc_id, r.gone or 0, bytes(r.kept)) for r in got) == sorted((i, n, kept) for i, _, n, kept in brute_rows(rows, 50))
    cut = suffix.cut_repeats(docs.withColumn("n_chars", F.length("text").cast("long")), 50).collect()
    assert sorted((r.doc_id, r.text or "") for r in cut) == sorted((i, kept.decode()) for i, _, _, kept in brute_rows(rows, 50))
    assert all(r.n_chars == (None if r.text is None else len(r.text)) for r in cut)


@pytest.mark.parametrize("width", [50, 7])
def test_windows_without_partners_are_not_sorted(spark, monkeypatch, width):
    """Copied passages whose surroundings differ share strings; windows that only share their anchor by chance, or have it alone, are settled without a sort."""
    rng = np.random.default_rng(width)
    texts = [bytes(rng.integers(97, 109 if width == 7 else 123, int(rng.integers(0, 400))).astype(np.uint8)) for _ in range(60)]
    k = suffix.gram_size(width)
    for i in range(20, 60):  # a copy of each length around the width, some only as long as the part that has the anchor
        a, n = int(rng.integers(0, 20)), int(rng.integers(k, 3 * width))
        texts[i] += texts[a][:n] + texts[i][: i % 3]
    data = [(i, t.decode()) for i, t in enumerate(texts)] + [(100 + i, f"x{texts[i].decode()}") for i in range(10)]
    rows = brute.repeated_bytes(data, width)
    gone = {i: r[1] for i, r in rows.items()}
    shards = {}
    for a, (i, t) in enumerate(data):
        raw = np.frombuffer(t.encode(), np.uint8)
        for key, first, last, place in zip(*(x.tolist() for x in suffix.anchors(raw, np.array([0, len(raw)]), width)[1:]), strict=True):
            shards.setdefault(raw[first : last + width].tobytes(), []).append((i, place - first))
    size = np.array([len(w) for w in shards])
    about = np.zeros(len(size), suffix._WINDOW)
    about["id"], about["size"] = np.arange(len(size)), size
    about["low"], about["high"] = [min(u)[0] for u in shards.values()], [max(u)[0] for u in shards.values()]
    about["anchor"] = [u[0][1] for u in shards.values()]
    raw = np.frombuffer(b"".join(shards), np.uint8)
    alone = suffix._alone(suffix._cores(raw, np.cumsum(size) - size, about, width))
    assert 0.1 * len(size) < alone.sum() < len(size)
    whole = np.concatenate(list(suffix.window_runs(io.BytesIO(raw.tobytes()), size, about, width, 1 << 30)))
    own = suffix._own_runs(size[alone], about[alone], width)
    assert sorted(own.tolist()) == sorted(r for r in whole.tolist() if alone[r[0]])
    rest = np.concatenate([np.zeros(0, suffix._RUN), *suffix.window_runs(suffix._chosen(io.BytesIO(raw.tobytes()), size, ~alone, 1 << 30, 7), size[~alone], about[~alone], width, 1 << 30)])
    assert sorted([*own.tolist(), *rest.tolist()]) == sorted(whole.tolist()) and len(rest)
    docs = spark.createDataFrame(data, "doc_id long, text string")
    assert {i: r[1] for i, r in digest(docs, width).items()} == gone


def test_shards_sort_only_what_can_match(monkeypatch):
    """Of windows with one anchor and unlike surroundings none reaches the sort; of two that agree on one side both do."""
    sorted_bytes = []
    real = suffix.window_runs
    monkeypatch.setattr(suffix, "window_runs", lambda file, size, *rest: sorted_bytes.append(int(size.sum())) or real(file, size, *rest))
    rng = np.random.default_rng(5)
    gram = "the anchor of them  "
    about = lambda n: "".join(map(chr, rng.integers(97, 123, n)))
    right = about(40)
    texts = [about(40) + gram + (right if i < 2 else about(40)) for i in range(40)]
    key = suffix.anchors(np.frombuffer(gram.encode() + right.encode(), np.uint8), np.array([0, 60]), 50)[1]
    assert len(key)
    batch = pa.RecordBatch.from_pydict(
        {"doc_id": list(range(40)), "text": texts, "keys": [_keys(t) for t in texts], "variant": pa.array([0] * 40, pa.int32())}
    )
    emitted = next(suffix._emit_windows(50, 1)([batch]))
    windows = np.concatenate([suffix._unpacked(x, suffix._WINDOW) for x in emitted["about"].to_pylist()])
    list(suffix._shard(50, 1 << 20)((pa.scalar(0),), iter([emitted.select(["shard", "data", "about"])])))
    assert 0 < sorted_bytes[0] < windows["size"].sum() / 5


def test_shards_follow_the_texts(spark, monkeypatch):
    """Few partitions don't make large shards; the result is the same."""
    rng = random.Random(9)
    parts = ["".join(rng.choice("abcdef ") for _ in range(120)) for _ in range(9)]
    rows = [(i, rng.choice(parts) + str(i) * 9 + rng.choice(parts)) for i in range(40)]
    many = []
    for name in ("_emit_keys", "_emit_windows", "_look_up"):
        monkeypatch.setattr(suffix, name, lambda width, n, real=getattr(suffix, name): many.append(n) or real(width, n))
    monkeypatch.setattr(suffix, "SHARD_TEXT", 1000)
    assert digest(spark.createDataFrame(rows, "doc_id long, text string")) == brute.repeated_bytes(rows)
    assert many == [-(sum(len(t) for _, t in rows) // -1000)] * 3 and many[0] > 4


def _keys(text):
    raw = np.frombuffer(text.encode(), np.uint8)
    return np.unique(suffix.anchors(raw, np.array([0, len(raw)]), 50)[1]).astype(np.int64).tolist()
