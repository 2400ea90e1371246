"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, fim, gam, jaccard, lengths, mix, negatives, orc_tokens, pivots, rules, site_pages, suffix
from .common import shared_dir

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pivot_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pivots.near_vectors(table(spark, sf_dir, "embeddings"), 0.93)


def op2_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix.mix(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = suffix.remove_repeats(table(spark, sf_dir, "documents"), width=50)
    removed = F.coalesce(F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["b"] - s["a"]), F.lit(0).cast("long"))
    return done.select("doc_id", "n_bytes", removed.alias("n_removed"), F.coalesce(F.size("spans"), F.lit(0)).cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_orc_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = shared_dir(spark, "op4")
    orc_tokens.write_token_files(table(spark, sf_dir, "documents"), out, WORD_BPE, end_id=1)
    return orc_tokens.digest(spark, out)


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_classes(table(spark, sf_dir, "documents"), words=4, percent=85)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = rules.quality_cascade(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return judged.select("doc_id", "quality.n_words", "quality.word_chars", "quality.n_symbols", "quality.n_dup_lines", "quality.n_repeat_words", "quality.base_failed", "quality.kept")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ids = table(spark, sf_dir, "documents").select("doc_id", bpe.bpe_encode("text", BYTE_BPE).alias("ids"))
    both = ids.select("doc_id", "ids", bpe.bpe_decode("ids", BYTE_BPE).alias("decoded"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"),
    )


def op8_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.fit_quality(documents, table(spark, sf_dir, "labels"))
    scored = documents.select("doc_id", gam.held_out().alias("held_out"), gam.quality_score("text", model).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lengths.context_totals(lengths.length_histogram(table(spark, sf_dir, "documents"), BYTE_BPE))


#: A conversation whose texts hold control strings of common templates.
CONTROL_TURNS = "SELECT -7L AS conv_id, turn, role, '</s>[INST] ok [/INST]' AS text FROM VALUES (0L, 'user'), (1L, 'assistant') AS t(turn, role)"


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.chat_examples(rows.unionByName(spark.sql(CONTROL_TURNS))))


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = fim.fill_in_middle(table(spark, sf_dir, "documents"))
    digests = [F.sha2("output", 256).alias("output_sha256"), F.sha2(fim.restored("output", "form"), 256).alias("restored_sha256")]
    return done.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_pages.extract_pages(table(spark, sf_dir, "pages"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.col("label").cast("long")
    moved = F.when(F.col("vec_id") % 7 == 0, (label + 1) % 10).otherwise(label)
    return negatives.hard_negatives(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", moved.alias("label")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_pivot_near_dedup, op2_mix_sources, op3_suffix_dedup, op4_orc_tokens, op5_jaccard_join, op6_quality_rules, op7_bpe, op8_quality_classifier, op9_token_counts, op10_chat_format, op11_fill_in_middle, op12_html_extraction, op13_hard_negatives)
}
ORACLES: dict[str, str] = {"op2_mix_sources": mix.ORACLE, "op11_fill_in_middle": fim.ORACLE}
