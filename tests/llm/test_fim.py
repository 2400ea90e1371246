import hashlib

import pytest

from gristmill.llm import fim, queries

from . import brute

SCHEMA = "doc_id long, text string, output string, form int"


def expected(doc_id, text, units):
    """By hand: the cut offsets from lists of units."""
    text = text or ""
    digits = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digits[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    low, high = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if text == "" or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    p, m, s = ("".join(x) for x in (units[:low], units[low:high], units[high:]))
    out = f"<S>{s}<P>{p}<M>{m}" if h[3] % 100 < 20 else f"<P>{p}<S>{s}<M>{m}"
    return n, "spm" if h[3] % 100 < 20 else "psm", len(p), len(m), out


def rows_of(df):
    return sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in df.collect()), key=repr)


def test_code_points(spark):
    odd = [*brute.ODD_TEXTS, "<P", "a<S>b", "<M>", "<S<P<M", "é\U0001f600\n\r\n", "<", "\x00 x", "x" * 300_000]
    rows = [(k, t, "c", k) for k, t in enumerate(odd * 12)] + [(None, "no id", "c", 1), (5, "twice", "c", 1), (5, "twice", "c", 1), (5, "other text", "c", 2)]
    df = spark.createDataFrame(rows, SCHEMA)
    done = fim.fill_in_middle(df)
    assert rows_of(done) == sorted(((i, *expected(i, t, list(t or ""))) for i, t, *_ in rows), key=repr)
    assert {r.form for r in done.collect()} == {"plain", "psm", "spm"}
    back = done.select("doc_id", fim.restored("output", "form").alias("text")).collect()
    assert sorted((repr(r.doc_id), r.text) for r in back) == sorted((repr(i), t or "") for i, t, *_ in rows)


def test_other_units_and_shares(spark):
    rows = [(k, f"  one two{' three' * (k % 7)}\nfour ", "c", 1) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    words = fim.fill_in_middle(df, unit=r"\S+\s*|\s+")
    split = lambda t: ["  ", *(w + (" " if j else "\n") for w, j in zip(t.split()[:-1], [1] * (len(t.split()) - 2) + [0], strict=True)), "four "]
    assert rows_of(words) == sorted(((i, *expected(i, t, split(t))) for i, t, *_ in rows), key=repr)
    assert {r.form for r in fim.fill_in_middle(df, plain=0, suffix_first=100).collect()} == {"spm"}
    assert {r.form for r in fim.fill_in_middle(df, plain=100).collect()} == {"plain"}
    with pytest.raises(Exception, match="sequence of units"):
        fim.fill_in_middle(df, unit=r"\w").collect()


def test_bytes_that_are_not_utf8(spark):
    df = spark.sql("SELECT id AS doc_id, CAST(X'61FF62C328C3A9' AS string) AS text FROM range(30)")
    done = fim.fill_in_middle(df)
    assert {r.n for r in done.select("n").collect()} == {6}
    assert done.where("form = 'plain' AND hex(CAST(output AS binary)) <> '61FF62C328C3A9'").count() == 0


def test_no_rows_and_registered_query(spark, sf):
    assert fim.fill_in_middle(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    for r in queries.op11_fill_in_middle(spark, sf).collect():
        n, form, prefix, middle, output = expected(r.doc_id, docs[r.doc_id], list(docs[r.doc_id] or ""))
        assert (r.n, r.form, r.prefix_chars, r.middle_chars, r.output_sha256) == (n, form, prefix, middle, hashlib.sha256(output.encode()).hexdigest())
        assert r.restored_sha256 == hashlib.sha256((docs[r.doc_id] or "").encode()).hexdigest()
