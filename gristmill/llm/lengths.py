"""Exact token counts from a histogram of encoded lengths.

Documents are aggregated by their encoded length; suffix sums over the distinct lengths answer
totals, quantiles and truncated totals for every context limit without reading texts again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .bpe import token_count
from .common import stored

BLOCK = 1024


def length_histogram(documents: DataFrame, path: str, *by: str) -> DataFrame:
    """(by..., length, n_docs): documents of each encoded length; null texts have length 0."""
    counted = documents.select(*by, token_count("text", path).alias("length"))
    return counted.groupBy(*by, "length").agg(F.count("*").alias("n_docs"))


def context_totals(histogram: DataFrame, *by: str) -> DataFrame:
    """One row per distinct length L, taken as a context limit.

    n_docs: documents of length L; docs_over: longer ones; tokens_over: their tokens;
    total_tokens: all tokens; truncated_tokens: tokens left if each document is cut to L;
    docs_upto_share: share of documents that fit whole. Totals for a limit between two distinct
    lengths follow from the row below it: truncated_tokens + docs_over * (limit - L).

    The sums run in two levels (inside blocks of 1024 lengths, then over blocks), so no task gets
    all lengths. The histogram is stored first, as it is read twice. An empty one gives no rows.
    """
    h = stored(histogram, "histogram").withColumn("block", F.floor(F.col("length") / BLOCK))
    h = h.withColumn("tokens", F.col("length") * F.col("n_docs"))
    blocks = h.groupBy(*by, "block").agg(F.sum("n_docs").alias("b_docs"), F.sum("tokens").alias("b_tokens"))
    later = Window.partitionBy(*by).orderBy(F.col("block").desc()).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    zero = F.lit(0).cast("long")
    blocks = blocks.select(
        *by,
        "block",
        F.coalesce(F.sum("b_docs").over(later), zero).alias("later_docs"),
        F.coalesce(F.sum("b_tokens").over(later), zero).alias("later_tokens"),
        F.sum("b_docs").over(whole).alias("all_docs"),
        F.sum("b_tokens").over(whole).alias("total_tokens"),
    )
    inside = Window.partitionBy(*by, "block").orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)
    own = h.select(
        *by,
        "block",
        "length",
        "n_docs",
        F.coalesce(F.sum("n_docs").over(inside), zero).alias("in_docs"),
        F.coalesce(F.sum("tokens").over(inside), zero).alias("in_tokens"),
    )
    both = own.join(blocks, [*by, "block"])
    over = both.withColumns({"docs_over": F.col("in_docs") + F.col("later_docs"), "tokens_over": F.col("in_tokens") + F.col("later_tokens")})
    return over.select(
        *by,
        "length",
        "n_docs",
        "docs_over",
        "tokens_over",
        "total_tokens",
        (F.col("total_tokens") - F.col("tokens_over") + F.col("docs_over") * F.col("length")).alias("truncated_tokens"),
        ((F.col("all_docs") - F.col("docs_over")) / F.col("all_docs")).alias("docs_upto_share"),
    )


def truncated_total(totals: DataFrame, limit: int) -> Column | DataFrame:
    """Tokens left when every document is cut to `limit`, from the rows of `context_totals`.

    The greatest distinct length not above the limit decides; below the least length every document
    is cut, so its row with the documents of that length counted as longer ones is used.
    """
    low = totals.where(F.col("length") <= limit).orderBy(F.col("length").desc()).limit(1)
    high = totals.orderBy("length").limit(1)
    by_low = low.select((F.col("truncated_tokens") + F.col("docs_over") * (F.lit(limit) - F.col("length"))).alias("tokens"), F.lit(0).alias("o"))
    by_high = high.where(F.col("length") > limit).select(((F.col("docs_over") + F.col("n_docs")) * F.lit(limit)).alias("tokens"), F.lit(1).alias("o"))
    return by_low.unionByName(by_high).orderBy("o").limit(1).select(F.col("tokens").cast("long").alias("truncated_tokens"))


def length_quantile(totals: DataFrame, q: float) -> DataFrame:
    """The least length L such that at least a share q of documents is no longer than L."""
    return totals.where(F.col("docs_upto_share") >= q).orderBy("length").limit(1).select("length")
