"""What each operator does with long texts, null and repeated ids, empty tables and clashing columns; the exact parts of op4, op6, op8 and op10."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from gristmill.llm import bpe, chat, gam, jaccard, lengths, mix, orc_tokens, queries, rules, suffix, units
from gristmill.llm.common import CHUNK_BYTES, SpanHash, gram_hash, shared_dir

from . import brute

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, row string, node string"


@pytest.fixture(scope="module")
def long_rows():
    """Two texts of more than a chunk that are near copies, and short ones."""
    rng = random.Random(8)
    words = [rng.choice(["river", "Stein", "l'eau", "mañana", "42", "a|b"]) + str(rng.randrange(3000)) for _ in range(140_000)]
    long = " ".join(words)
    assert len(long.encode()) > CHUNK_BYTES + 10_000
    other = " ".join(["new", *words[:60_000], "put", *words[60_000:]])
    return [(4, long), (7, "short text of a few words"), (9, other), (11, None), (12, long)]


@pytest.fixture(scope="module")
def long_df(spark, long_rows):
    return spark.createDataFrame([(*r, "en", "s", 1, "x", "y") for r in long_rows], SCHEMA)


def test_long_texts_are_whole(spark, long_df, long_rows):
    byte, word = (Tokenizer.from_file(p) for p in (queries.BYTE_BPE, queries.WORD_BPE))
    ids = {i: byte.encode(t or "", add_special_tokens=False).ids for i, t in long_rows}
    got = long_df.select("doc_id", bpe.unpack_ids(bpe.bpe_encode("text", queries.BYTE_BPE)).alias("ids")).collect()
    assert {r.doc_id: list(r.ids) for r in got} == ids
    assert {r.length: r.n_docs for r in lengths.length_histogram(long_df, queries.BYTE_BPE).collect()} == {n: [len(x) for x in ids.values()].count(n) for n in map(len, ids.values())}
    out = shared_dir(spark, "orc")
    orc_tokens.write_token_files(long_df, out, queries.WORD_BPE, 1)
    want = {i: brute.crc_of_ids([*word.encode(t or "", add_special_tokens=False).ids, 1]) for i, t in long_rows}
    assert {r.doc_id: r.ids_crc32 for r in orc_tokens.digest(spark, out).collect()} == want
    judged = {r.doc_id: r.quality for r in rules.quality_cascade(long_df).collect()}
    assert {i: tuple(q[:5]) + (q.base_failed,) for i, q in judged.items()} == {i: brute.rule_digest(t) for i, t in long_rows}
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_classes(long_df, 4, 85).collect()} == brute.near_texts(long_rows)
    cut = {r.doc_id: (r.n_bytes, sum(s.b - s.a for s in r.spans or []), len(r.spans or [])) for r in suffix.remove_repeats(long_df).collect()}
    assert cut == {i: v[:3] for i, v in brute.repeated_bytes(long_rows).items()}
    assert {r.doc_id: r.n_tokens for r in mix.mix(long_df).collect()} == {i: len(brute.WORD.findall(t or "")) for i, t in long_rows}
    model = gam.fit_quality(long_df, spark.createDataFrame([(4, 1), (7, 0)], "doc_id long, quality int"))
    assert all(0 <= r.s <= 1 for r in long_df.select(gam.quality_score("text", model).alias("s")).collect())
    said = spark.createDataFrame([(1, 0, "user", long_rows[0][1]), (1, 1, "assistant", long_rows[2][1])], "conv_id long, turn long, role string, text string")
    assert chat.read_back(chat.chat_examples(said)).first().loss_chars == len(long_rows[2][1])


@pytest.mark.parametrize("empty", [True, False])
def test_null_and_repeated_ids(spark, empty):
    texts = ["one two three four five six", "one two three four five six", None, "", "seven eight nine ten eleven"]
    rows = [(i, t, None, None, None, "x", "y") for i, t in zip([None, None, 3, 3, 3], texts, strict=True)] + [(3, texts[4], None, None, None, "x", "y")]
    df = spark.createDataFrame([] if empty else rows, SCHEMA)
    n = 0 if empty else len(rows)
    library = Tokenizer.from_file(queries.BYTE_BPE)
    sizes = sorted(len(library.encode(r[1] or "", add_special_tokens=False).ids) for r in rows[:n])
    assert sorted(r.n for r in df.select(bpe.token_count("text", queries.BYTE_BPE).alias("n")).collect()) == sizes
    assert bpe.encode_documents(df, queries.BYTE_BPE).count() == n and lengths.length_histogram(df, queries.BYTE_BPE).agg(F.sum("n_docs")).first()[0] == (n or None)
    out = shared_dir(spark, "orc")
    orc_tokens.write_token_files(df, out, queries.WORD_BPE, 1)
    back = orc_tokens.digest(spark, out).orderBy("start", "n_tokens").collect()
    assert len(back) == n and [r.start for r in back] == np.concatenate(([0], np.cumsum([r.n_tokens for r in back])[:-1])).tolist()[:n]
    assert [r.doc_id is None for r in back] == [True, True, False, False, False, False][:n]
    judged = rules.quality_cascade(df).collect()
    assert len(judged) == n and not any(r.quality.kept for r in judged) and rules.quality_cascade(df).columns == [*df.columns, "quality"]
    assert jaccard.jaccard_classes(df).count() == n and suffix.remove_repeats(df).count() == n and mix.mix(df).count() == n
    assert jaccard.drop_near_copies(df).columns == df.columns and jaccard.drop_near_copies(df).count() == (0 if empty else 4)
    assert gam.keep_quality(df, spark.createDataFrame([(3, 1), (None, 0)], "doc_id long, quality int")).columns == df.columns


def test_rules_measure_no_text_that_was_rejected(spark):
    """Each rule sees the survivors of those before it, and figures that are there already come along."""
    seen = {}

    def rule(name, bad):
        def rejects(block):
            seen[name] = block.n_words().tolist()
            return np.isin(block.n_words(), bad)

        return rules.Rule(name, rejects)

    texts = ["word " * n for n in range(1, 8)]
    raw = [t.encode() for t in texts]
    block = rules.TextBlock(np.frombuffer(b"".join(raw), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in raw]))))
    rules.digest_of(block)
    found = rules.cascade(block, (rule("a", [2, 5]), rule("b", []), rule("c", [1, 7]), rule("d", [3])))
    assert found.tolist() == [2, 0, 3, -1, 0, -1, 2]
    assert seen == {"a": [1, 2, 3, 4, 5, 6, 7], "b": [1, 3, 4, 6, 7], "c": [1, 3, 4, 6, 7], "d": [3, 4, 6]}
    figures = rules.estimate(spark.createDataFrame([(k, "fine words " * 30 if k % 3 else "## $$ %% " * 30 + "x" * k) for k in range(60)], "doc_id long, text string"), rules.EXTRA_RULES, base=())
    by = {name: (cost, share) for name, cost, share in figures}
    assert abs(by["symbols"][1] - 1 / 3) < 0.01 and by["shouting"][1] == 0 and all(c > 0 for c, _ in by.values())


def test_measurements_of_a_subset():
    """A subset carries what is measured: the same values as measuring the texts anew."""
    rng = random.Random(3)
    texts = [t or "" for t in brute.ODD_TEXTS] + [" ".join(rng.choice(["ab", "Cd", "x#", "\n", "é"]) for _ in range(rng.randrange(60))) for _ in range(40)]
    raw = [t.encode() for t in texts]

    def block(some):
        return rules.TextBlock(np.frombuffer(b"".join(some), np.uint8), np.concatenate(([0], np.cumsum([len(x) for x in some]))).astype(np.int64))

    names = ("n_words", "word_chars", "n_chars", "n_symbols", "n_upper", "n_letters", "n_lines", "n_dup_lines", "n_repeat_words", "n_same_next")
    keep = np.sort(np.array(rng.sample(range(len(texts)), 30)))
    for before in ((), ("n_words", "n_dup_lines"), names):
        whole = block(raw)
        for n in before:
            getattr(whole, n)()
        part, fresh = whole.subset(keep), block([raw[k] for k in keep])
        assert all((getattr(part, n)() == getattr(fresh, n)()).all() for n in names)


def test_rules_verdict_equals_brute_force(spark, sf):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()] + [(-1 - k, t) for k, t in enumerate(brute.ODD_TEXTS)]
    got = {r.doc_id: r.kept for r in rules.quality_cascade(spark.createDataFrame(rows, "doc_id long, text string")).select("doc_id", "quality.kept").collect()}
    assert got == {i: brute.rules_keep(t) for i, t in rows}


def test_classifier_columns(spark, sf):
    """held_out against zlib, predicted against the score, the score against the model on the text alone."""
    rows = queries.op8_quality_classifier(spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r.doc_id for r in rows} == set(texts)
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1
    by_text = {}
    for r in rows:
        by_text.setdefault(texts[r.doc_id], set()).add(r.score)
    assert all(len(s) == 1 for s in by_text.values())
    assert len({r.score for r in rows}) > 20


def test_labels_of_the_held_out_part_change_nothing(spark, sf):
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    turned = labels.withColumn("quality", F.when(gam.held_out(), 1 - F.col("quality")).otherwise(F.col("quality")))
    documents = spark.read.parquet(f"{sf}/documents.parquet")
    a, b = (gam.fit_quality(documents, x) for x in (labels, turned))
    assert all((x == y).all() for x, y in zip(a.tables, b.tables, strict=True)) and a.intercept == b.intercept


def test_chat_sizes(spark, sf):
    data = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = {r.conv_id: r.formatted_chars for r in queries.op10_chat_format(spark, sf).collect()}
    assert got == brute.chat_chars([*data, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")])


def test_orc_files_have_stripes_indexes_and_bloom_filters(spark):
    """Several stripes, row indexes, Bloom filters on doc_id, and a look-up that reads one row group only."""
    rng = random.Random(1)
    rows = [(3 * i, " ".join(str(rng.randrange(10**9)) for _ in range(12))) for i in range(6000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    out = shared_dir(spark, "orc")
    keep = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "1")
    try:
        orc_tokens.write_token_files(df, out, queries.WORD_BPE, 1, **{"orc.stripe.size": "40000", "orc.row.index.stride": "1000"})
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", keep)
    jvm = spark._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(next(f for f in spark.read.orc(out).inputFiles()))
    reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(conf))
    assert reader.getStripes().size() > 1 and reader.getRowIndexStride() == 1000 and reader.getCompressionKind().toString() == "ZSTD"
    streams = reader.rows().readStripeFooter(reader.getStripes().get(0)).getStreamsList()
    kinds = {(s.getColumn(), s.getKind().toString()) for s in streams}
    encodings = {reader.rows().readStripeFooter(reader.getStripes().get(0)).getColumns(c).getKind().toString() for c in (1, 2)}
    assert (1, "BLOOM_FILTER_UTF8") in kinds and (1, "ROW_INDEX") in kinds and encodings == {"DIRECT_V2"}
    one = orc_tokens.read_token_files(spark, out).where(F.col("doc_id") == 3 * 4321)
    assert one.count() == 1 and orc_tokens.read_token_files(spark, out).where(F.col("doc_id") == 3 * 4321 + 1).count() == 0
    one = one.select("doc_id", "n_tokens")
    assert len(one.collect()) == 1
    leaf = one._jdf.queryExecution().executedPlan().collectLeaves().head()
    assert leaf.metrics().apply("numOutputRows").value() <= 1000


def test_mix_with_given_targets(spark):
    """Targets of one margin are met by the expected tokens, the others keep their tempered shares."""
    rows = [(i, "word " * 40 + ("|" if i % 5 == 0 else ""), ["en", "de"][i % 4 == 0], "ab"[i % 3 == 0]) for i in range(1200)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    targets = {"source": spark.createDataFrame([("a", 0.5), ("b", 0.5)], "level string, target double"), "lang": spark.createDataFrame([("en", 0.6), ("de", 0.4)], "level string, target double")}
    got = mix.mix(df, targets, budget=mix.EXACT).collect()
    total = sum(r.probability * r.n_tokens for r in got)
    share = lambda m, level: sum(r.probability * r.n_tokens for r in got if r[m] == level) / total
    assert abs(share("source", "a") - 0.5) < 0.01 and abs(share("lang", "de") - 0.4) < 0.01
    few = mix.mix(df, targets, budget=5000).collect()
    assert abs(sum(r.probability * r.n_tokens for r in few) - 5000) < 1
    assert {r.doc_id for r in few if r.kept} == {r.doc_id for r in mix.sample_mix(df, targets, budget=5000).collect()}


def test_topics_and_given_token_counts(spark):
    """The topic whose terms occur most often, ties by the order of topics; token counts may come from a column."""
    texts = [None, "", "plain words", "a|b|c mail: x@y", "x@y | license", "License, Copyright: see www.a.com", "### *** </b> x@y", "a\tb\tc;d", "||", "😀@@ é://x"]
    df = spark.createDataFrame([(i, t, "en", "s", 10 * i) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, size int")
    want = []
    for t in texts:
        n = {name: sum((t or "").count(x) for x in terms) for name, terms in mix.TOPICS.items()}
        want.append(max(n, key=n.get) if any(n.values()) else mix.NO_TOPIC)
    assert [r.topic for r in mix.mix(df).orderBy("doc_id").collect()] == want and len(set(want)) > 4
    own = mix.mix(df, topics={"shout": ("!",), "see": ("see", "://")}, tokens="size").orderBy("doc_id").collect()
    assert [r.topic for r in own] == ["prose"] * 5 + ["see"] + ["prose"] * 3 + ["see"] and [r.n_tokens for r in own] == [10 * i for i in range(len(texts))]


def test_units_whose_hashes_clash_keep_their_own_ids(monkeypatch):
    """Long pre-tokens that share a hash are told apart by their bytes, in one chunk and over several."""
    keep = units.SpanHash.of
    monkeypatch.setattr(units.SpanHash, "of", lambda self, a, b: np.where(b - a > 8, keep(self, a, b) % np.uint64(3), keep(self, a, b)))
    library = Tokenizer.from_file(queries.BYTE_BPE)
    made = bpe.BytePairCoder(queries.BYTE_BPE)
    table = units.UnitTable(made.encode_unit)
    texts = [t or "" for t in brute.ODD_TEXTS] + ["internationally " + "x" * k + " counterproductive" for k in range(12)]
    for some in (texts, texts[::-1]):
        got = [x for ids, n in units.encode_texts(pa.array(some), table, made.encode_text, tuple(made.special), keep_space=True, lower=False) for x in np.split(ids, np.cumsum(n)[:-1])]
        assert [x.tolist() for x in got] == [library.encode(t, add_special_tokens=False).ids for t in some]


def test_span_hashes_tell_spans_apart():
    """Every distinct span of some bytes, short and long, has a hash of its own; equal spans share theirs wherever they lie."""
    data = np.frombuffer((brute.THUE_MORSE[:300] + "the cat, the hat\\n" * 9).encode(), np.uint8)
    raw, hasher, seen = data.tobytes(), SpanHash(data), {}
    for size in (*range(1, 20), 63, 64, 65, 128):
        start = np.arange(len(raw) - size + 1)
        for a, h in zip(start.tolist(), hasher.of(start, start + size).tolist(), strict=True):
            assert seen.setdefault(h, raw[a : a + size]) == raw[a : a + size]
        grams = gram_hash(data, size, block=50)
        assert len(np.unique(grams)) == len({raw[a : a + size] for a in start.tolist()})
    assert len(seen) == len({raw[a : a + size] for size in (*range(1, 20), 63, 64, 65, 128) for a in range(len(raw) - size + 1)})
