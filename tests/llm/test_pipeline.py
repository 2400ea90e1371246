import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from gristmill.llm import mix

from . import brute

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark, sf):
    """Every stage against its own input: classifier by labels, the others by brute force."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS)
    texts = lambda df: {r.doc_id: r.text for r in df.collect()}
    first = P.classify(spark, docs, sf).cache()
    assert first.columns == COLUMNS
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = set(texts(first))
    good = [i for i, q in labels.items() if q == 1]
    bad = [i for i, q in labels.items() if q == 0]
    assert sum(i in kept for i in good) >= 0.97 * len(good) and sum(i in kept for i in bad) <= 0.2 * len(bad)
    second = P.near_copies(spark, first, sf).cache()
    near = brute.near_texts(list(texts(first).items()), 5, 80)
    assert second.columns == COLUMNS and set(texts(second)) == {i for i, (_, c) in near.items() if i == c}
    third = P.repeated_passages(spark, second, sf).cache()
    before, after = texts(second), texts(third)
    removed = brute.repeated_bytes(list(before.items()), P.PASSAGE_BYTES)
    assert third.columns == COLUMNS and set(after) == set(before)
    for i, t in after.items():
        lost = len(before[i].encode()) - len(t.encode())
        assert removed[i][1] - 6 * removed[i][2] <= lost <= removed[i][1]
    assert third.where(F.col("n_chars") != F.length("text")).count() == 0
    fourth = P.mix_sources(spark, third, sf).cache()
    assert fourth.columns == COLUMNS
    assert set(texts(fourth)) == {r.doc_id for r in mix.mix(third).collect() if r.kept}
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    last = P.encode(spark, fourth, sf).collect()
    want = texts(fourth)
    assert len(last) == len(want) > 0
    assert all(list(r.ids) == library.encode(want[r.doc_id], add_special_tokens=False).ids and r.n_tokens == len(r.ids) for r in last)


def test_short_words_of_a_repeated_passage_are_cut(spark, sf):
    passage = " ".join("abcdefghij"[(i * i) % 10] for i in range(51))
    rows = [(i, f"{head} {passage} {tail}", "en", "s", 1) for i, head, tail in ((1, "first", "here"), (2, "second", "there"))]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    got = {r.doc_id: r.text for r in P.repeated_passages(spark, docs, sf).collect()}
    assert got[1] == rows[0][1] and passage not in got[2] and len(got[2]) < 20


def test_odd_rows(spark, sf):
    rows = [(i, t, None if i % 2 else "en", "s" if i % 3 else None, None) for i, t in enumerate(brute.ODD_TEXTS)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    for some in (docs, docs.limit(0)):
        for _, stage in P.STAGES:
            assert stage(spark, some, sf).count() <= len(rows)


def test_an_id_with_two_texts(spark, tmp_path, sf):
    """The whole pipeline over rows whose id repeats, one text far shorter than what the other repeats."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select(*COLUMNS)
    long = docs.orderBy(F.length("text").desc()).first()
    extra = [(10**6, f"{long.text} more", "en", "s", 1), (10**6, "A short text of its own.", "en", "s", 1), (10**6, None, "en", "s", 1)]
    both = docs.unionByName(spark.createDataFrame(extra, docs.schema)).withColumn("n_chars", F.length("text").cast("long"))
    both.write.parquet(f"file://{tmp_path}/documents.parquet")
    spark.read.parquet(f"{sf}/labels.parquet").write.parquet(f"file://{tmp_path}/labels.parquet")
    out = P.run(spark, f"file://{tmp_path}").collect()
    assert 0 < len(out) <= both.count() and all(r.n_tokens == len(r.ids) for r in out)
