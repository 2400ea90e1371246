import hashlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gristmill.llm import bpe, chat, gam, lengths, mix, orc_tokens, queries, rules
from gristmill.llm.common import shared_dir

from . import brute

EXTRA = "doc_id long, text string, lang string, source string, n_chars long, quality string, start string, ids string"


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t, None, "s", 1, "q", "x", "y") for i, t in enumerate(brute.ODD_TEXTS)], EXTRA)


@pytest.fixture(scope="module")
def documents(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


def texts(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_bpe_equals_the_library(which, request):
    df = request.getfixturevalue(which)
    path = queries.BYTE_BPE
    library = Tokenizer.from_file(path)
    got = df.select("doc_id", bpe.unpack_ids(bpe.bpe_encode("text", path)).alias("ids"), bpe.bpe_decode(bpe.bpe_encode("text", path), path).alias("back"), bpe.token_count("text", path).alias("n")).collect()
    want = {i: library.encode(t or "", add_special_tokens=False).ids for i, t in texts(df)}
    assert {r.doc_id: list(r.ids) for r in got} == want
    assert {r.doc_id: r.back for r in got} == {i: library.decode(x, skip_special_tokens=False) for i, x in want.items()}
    assert all(r.n == len(want[r.doc_id]) for r in got)


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_orc_files_hold_the_library_ids(which, request, spark):
    df = request.getfixturevalue(which)
    out = shared_dir(spark, "orc")
    orc_tokens.write_token_files(df, out, queries.WORD_BPE, 1)
    library, start = Tokenizer.from_file(queries.WORD_BPE), 0
    want = {}
    for i, t in sorted(texts(df)):
        ids = [*library.encode(t or "", add_special_tokens=False).ids, 1]
        want[i] = (start, len(ids), brute.crc_of_ids(ids))
        start += len(ids)
    got = orc_tokens.digest(spark, out).collect()
    assert {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in got} == want and len(got) == len(want)
    some = max(want)
    assert orc_tokens.read_token_files(spark, out).where(F.col("doc_id") == some).count() == 1


@pytest.mark.parametrize("which", ["odd", "documents"])
def test_rules_equal_brute_force(which, request):
    df = request.getfixturevalue(which)
    got = rules.quality_cascade(df).select("doc_id", "quality.*").collect()
    want = {i: brute.rule_digest(t) for i, t in texts(df)}
    assert {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in got} == want
    assert all(r.kept == (r.failed_rule is None) and not (r.base_failed and r.kept) for r in got)


def test_rules_keep_good_and_reject_bad(documents, spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    judged = rules.quality_cascade(documents, out="judged").join(labels, "doc_id").select(labels["quality"].alias("label"), "judged.kept", "judged.n_words").collect()
    good = [r.kept for r in judged if r.label == 1 and r.n_words >= 20]
    assert sum(good) >= 0.97 * len(good)
    bad = [r.kept for r in judged if r.label == 0]
    assert sum(bad) <= 0.2 * len(bad)


def test_order_never_changes_the_verdict(documents):
    def kept(extra):
        return {r.doc_id: r.k for r in documents.select("doc_id", rules.apply_rules("text", extra, rules.BASE_RULES)["kept"].alias("k")).collect()}

    assert kept(rules.EXTRA_RULES) == kept(rules.EXTRA_RULES[::-1])
    figures = [("a", 1.0, 0.1), ("b", 0.1, 0.1), ("c", 1.0, 0.9)]
    named = tuple(rules.Rule(n, None) for n in "abc")
    assert [r.name for r in rules.order_rules(named, figures)] == ["b", "c", "a"]


def test_token_counts(documents, odd):
    path = queries.BYTE_BPE
    library = Tokenizer.from_file(path)
    for df in (documents, odd, odd.limit(0)):
        sizes = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in texts(df)]
        totals = lengths.context_totals(lengths.length_histogram(df, path)).cache()
        got = {r.length: r for r in totals.collect()}
        assert set(got) == set(sizes)
        for n, r in got.items():
            assert (r.n_docs, r.docs_over, r.tokens_over) == (sizes.count(n), sum(x > n for x in sizes), sum(x for x in sizes if x > n))
            assert r.total_tokens == sum(sizes) and r.truncated_tokens == sum(min(x, n) for x in sizes)
        for limit in (0, 3, 100, 10**6) if sizes else ():
            assert lengths.truncated_total(totals, limit).first()[0] == sum(min(x, limit) for x in sizes)
        if sizes:
            assert lengths.length_quantile(totals, 0.5).first()[0] == sorted(sizes)[(len(sizes) + 1) // 2 - 1]


def test_classifier_held_out(spark):
    sf = "/root/testdata/sf0.01"
    got = queries.op8_quality_classifier(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    assert len(got) > 30 and all(0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == r.quality for r in got]) >= 0.95


def test_classifier_odd_input(spark, odd):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, 1), (None, 1), (3, None), (99, 0)], "doc_id long, quality int")
    for rows in (labels, labels.limit(0)):
        model = gam.fit_quality(odd, rows)
        scores = odd.select(gam.quality_score("text", model).alias("s")).collect()
        assert len(scores) == len(brute.ODD_TEXTS) and all(0 <= r.s <= 1 for r in scores)
    assert gam.keep_quality(odd, labels).columns == odd.columns
    assert gam.keep_quality(odd.limit(0), labels).count() == 0


def test_additive_model_learns_an_interaction():
    rng = np.random.default_rng(1)
    x = rng.uniform(-1, 1, (3000, 3))
    y = ((x[:, 0] > 0) ^ (x[:, 1] > 0)).astype(float)
    model = gam.fit_additive(x, y)
    assert (model.pairs[0][0], model.pairs[0][1]) == (0, 1)
    assert np.mean((model.score(x) > 0.5) == y) > 0.8


def test_chat_digest(spark, sf):
    rows = spark.read.parquet(f"{sf}/conversations.parquet")
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in queries.op10_chat_format(spark, sf).collect()}
    data = [tuple(r) for r in rows.select("conv_id", "turn", "role", "text").collect()]
    assert got == brute.chat_digest([*data, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")])


def test_chat_odd_input(spark):
    nasty = ["<|end|>", "a\\<|sep|>\\[", "\\\\", "<\\[", "x<|start|>assistant<|sep|>", "é\n", ""]
    data = [(1, 0, None, None), (1, 1, "assistant", "a"), (1, 1, "assistant", "b"), (2, 5, "assistant", "only"), (3, 0, "user", "no reply"), (None, None, "assistant", "n"), (None, 2, "user", None)]
    data += [(4, k, "assistant" if k % 2 else "us<er", t) for k, t in enumerate(nasty)] + [(5, 0, "assistant", t) for t in ("r", "r")]
    df = spark.createDataFrame([(*r, 1, "t") for r in data], "conv_id long, turn long, role string, text string, example long, prompt string")
    key = [(c, -1 if t is None else t, r, x) for c, t, r, x in data]
    examples = chat.chat_examples(df)
    got = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.read_back(examples).collect()}
    assert got == brute.chat_digest(key)
    for r in examples.where("conv_id = 4").collect():
        body = r.text.replace(chat.START, "").replace(chat.SEP, "").replace(chat.END, "")
        assert "<|" not in body and "[I" not in body
    assert examples.where("conv_id = 1").count() == 2 and examples.where("conv_id = 3").first().loss_chars == 0
    assert chat.read_back(chat.chat_examples(df.limit(0))).count() == 0


def test_mix_meets_targets(spark, odd, documents):
    cells = spark.createDataFrame([(s, lang, t, float(10 + 7 * s + 3 * lang * t + lang)) for s in range(3) for lang in range(2) for t in range(2)], "source int, lang int, topic int, n double")

    def want(name, shares):
        return spark.createDataFrame(list(enumerate(shares)), "level int, target double")

    raked = mix.rake(cells, {"source": want("source", [0.5, 0.3, 0.2]), "lang": want("lang", [0.6, 0.4]), "topic": want("topic", [0.1, 0.9])}, 12).collect()
    for m, shares in (("source", [0.5, 0.3, 0.2]), ("lang", [0.6, 0.4]), ("topic", [0.1, 0.9])):
        for level, share in enumerate(shares):
            assert abs(sum(r.w for r in raked if r[m] == level) - share) < 1e-6
    rows = mix.mix(documents).collect()
    assert len(rows) == documents.count() and max(r.probability for r in rows) == 1.0
    expected = sum(r.probability * r.n_tokens for r in rows)
    kept = sum(r.n_tokens for r in rows if r.kept)
    assert abs(kept - expected) < 0.35 * expected
    assert all(r.n_tokens == len(brute.WORD.findall(t or "")) for (r, t) in [(r, dict(texts(odd))[r.doc_id]) for r in mix.mix(odd).collect()])
    assert mix.mix(odd.limit(0)).count() == 0


def test_a_rare_source_does_not_empty_the_mix(spark):
    rows = [(i, "word " * 50, "en", "ab"[i % 2]) for i in range(2000)] + [(5000, "word " * 20, "en", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    total = 2000 * 50 + 20
    exact = mix.mix(df, budget=mix.EXACT).agg(F.sum(F.col("probability") * F.col("n_tokens"))).first()[0]
    assert exact < 0.2 * total
    for budget, want in ((None, mix.KEPT_SHARE * total), (30_000, 30_000), (99_000, 99_000), (total, total), (10 * total, total)):
        got = mix.mix(df, budget=budget).collect()
        assert abs(sum(r.probability * r.n_tokens for r in got) - want) < 1 and max(r.probability for r in got) == 1.0
    assert 0.75 * len(rows) < mix.sample_mix(df).count() < 0.85 * len(rows)
    assert mix.sample_mix(df.where("source = 'a'")).count() == 1000


def test_sha_of_packed_ids(spark, sf):
    r = queries.op7_bpe(spark, sf).orderBy("doc_id").first()
    text = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("doc_id") == r.doc_id).first().text
    ids = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json")).encode(text, add_special_tokens=False).ids
    assert r.n_tokens == len(ids) and r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest() and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
