"""Connected components of an undirected graph by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, stored


def _star(edges: DataFrame, small: bool) -> DataFrame:
    """One step over (a, b) edges: each node hands its greater (large) or lesser (small) neighbours to its least one."""
    if small:
        directed = edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
    else:
        directed = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = directed.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    joined = directed.join(least, "u")
    if small:
        out = joined.select(F.col("v").alias("a"), F.col("m").alias("b")).unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
    else:
        out = joined.where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b"))
    return out.where("a <> b").distinct()


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for every node that has an edge; the component is its least node.

    `edges` holds (a, b) rows of a sortable type; loops and repeated edges don't matter, null ends are
    dropped. Each round's edges are stored, so lineage stays short; the driver sees only a count and
    a checksum per round. Rounds grow with the logarithm of the longest path.
    """
    now = stored(edges.where("a <> b").select("a", "b").distinct(), "edges")
    mark = None
    for _ in range(most_rounds):
        before, now = now, stored(_star(_star(now, small=False), small=True), "edges")
        discard(before)
        seen = now.agg(F.count("*").alias("n"), F.sum(F.pmod(F.xxhash64("a", "b"), F.lit(2**40))).alias("h")).first()
        if (seen.n, seen.h) == mark:
            break
        mark = (seen.n, seen.h)
    else:
        raise RuntimeError(f"components did not settle in {most_rounds} rounds")
    roots = now.select(F.col("b").alias("node")).distinct()
    out = now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))
    out.__dict__["_stored_path"] = now.__dict__["_stored_path"]  # for discard()
    return out
