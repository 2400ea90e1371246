"""Embedding near-duplicates by a pivot-permutation index.

Every vector is described by its ordered nearest reference points (pivots). Vectors that share enough
of them, in similar places of their orders, are candidates, found through inverted pivot lists, and their
cosine is verified in double precision. Of its L nearest pivots a vector is listed under the L-m+1 rarest
only: two vectors that share m pivots then still meet, and a pair counts in the list of the rarest pivot
they share, once. Nearness counts L for the nearest pivot down to 1; the agreement of two orders is the sum, over
shared pivots, of the products of both nearnesses.

Many embeddings share a direction, which says nothing about who is near whom: pivots and orders are of what is left of the unit
vectors without their mean. How alike the orders of two vectors at the threshold are depends on the table: L, m and the least
agreement are set on pairs at exactly the threshold, made from the sample, so that few of them are missed.
Lists are cut into blocks and pairs of blocks are compared in one task each, so that no task holds
a whole list and no pair of vectors is ever a row: a task returns each vector's number of links and
the root of its group within the task.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, stored
from .graph import components

#: Least and greatest number of pivots; in between as many as the root of the number of vectors, a power of two.
PIVOTS = (256, 16384)
#: Vectors in the bounded sample for each pivot that is chosen from it, and in all.
SAMPLE_PER_PIVOT, SAMPLE_ROWS = 16, 65_536
#: Numbers of nearest pivots to choose from, and the most that candidates must share.
NEAREST, SHARED = (12, 16, 24, 32, 48, 64, 96, 128), 4
#: The most that the orders of 12 nearest pivots must agree; more pivots, by the square of their number.
AGREEMENT = 150
#: Pairs at the threshold that the index is set on, and the share of them that may share too few pivots, or agree too little.
PAIRS, MISSED = 2000, 0.005
BLOCK_ROWS = 1024
#: Pivots are no closer to each other than the first of these cosines that leaves enough of them, so that a mass of near copies takes few.
APART = (0.8, 0.9, 0.95, 0.98, 0.99)


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    x = np.asarray(vectors, np.float64)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def as_matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    """Lists of one length, without nulls, as the rows of a matrix."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def pivots_for(n: int) -> int:
    """More pivots for more vectors, so that lists grow as the root of their number."""
    return int(min(PIVOTS[1], max(PIVOTS[0], 2 ** math.ceil(math.log2(max(n, 1)) / 2))))


def usable(v: Column) -> Column:
    """Whether a vector can link at all: not null or empty, all components finite, one of them not 0."""
    d = v.cast("array<double>")
    good = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(d) > 0) & good & F.exists(d, lambda x: x != 0), F.lit(False))


@dataclass
class Index:
    """Pivots of one dimension, and how vectors are compared by them."""

    mean: np.ndarray
    points: np.ndarray
    #: By rarity as nearest pivots of the sample (0: rarest).
    rank: np.ndarray
    many: int
    shared: int
    agreement: float

    def order(self, vectors: np.ndarray) -> np.ndarray:
        """Each vector's nearest pivots in order, as ranks by rarity."""
        return self.rank[nearest(residual(unit_rows(vectors), self.mean), self.points, self.many)]


def residual(x: np.ndarray, mean: np.ndarray) -> np.ndarray:
    """Unit vectors without their mean, as unit vectors again; what equals the mean stays as it is."""
    left = x - mean
    norm = np.sqrt((left * left).sum(1, keepdims=True))
    return np.where(norm > 1e-9, left / np.where(norm > 1e-9, norm, 1), x)


def far_apart(x: np.ndarray, most: int) -> np.ndarray:
    """Up to `most` rows, in their order, none close to one taken before."""
    for apart in APART:
        taken = [0]
        near = x @ x[0]
        for k in range(1, len(x)):
            if len(taken) >= most:
                break
            if near[k] < apart:
                taken.append(k)
                near = np.maximum(near, x @ x[k])
        if len(taken) >= min(most, len(x) // 2):
            break
    return x[taken]


def pairs_at(x: np.ndarray, threshold: float, many: int = PAIRS) -> tuple[np.ndarray, np.ndarray]:
    """Vectors of the sample and partners at exactly the threshold: half of them off in any direction, half towards another vector."""
    rng = np.random.default_rng(0)
    a = x[rng.integers(0, len(x), many)]
    off = np.where(np.arange(many)[:, None] % 2, rng.normal(size=a.shape), x[rng.integers(0, len(x), many)] + 1e-6 * rng.normal(size=a.shape))
    off = unit_rows(off - (off * a).sum(1, keepdims=True) * a) if x.shape[1] > 1 else a
    return a, unit_rows(threshold * a + math.sqrt(1 - threshold**2) * off)


def alike(p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shared pivots and agreement of the orders of each pair."""
    nearness = np.arange(p.shape[1], 0, -1)
    same = p[:, :, None] == q[:, None, :]
    return same.sum((1, 2)), (same * (nearness[:, None] * nearness[None, :])).sum((1, 2))


def index_of(sample: np.ndarray, most: int, threshold: float) -> Index:
    """The index of a sample of vectors: of the numbers of nearest pivots, the one with the least expected rows in its lists."""
    x = unit_rows(sample)
    mean = x.mean(0) if len(x) > 1 else np.zeros(x.shape[1])
    left = residual(x, mean)
    points = far_apart(left, most)
    near = [nearest(residual(v, mean), points, max(NEAREST)) for v in pairs_at(x, threshold)]
    best = None
    for many in NEAREST:
        many = min(many, len(points))
        shared, agreement = alike(*(v[:, :many] for v in near))
        least = int(min(SHARED, np.quantile(shared, MISSED)))
        rows = (many - least + 1) ** 2
        if least and (best is None or rows < best[0]):
            best = (rows, many, least, min(float(np.quantile(agreement, MISSED)), AGREEMENT * (many / 12) ** 2))
    _, many, shared, agreement = best or (0, min(max(NEAREST), len(points)), 1, 1.0)
    used = np.bincount(nearest(left, points, many).ravel(), minlength=len(points))
    rank = np.empty(len(points), np.int64)
    rank[np.lexsort((np.arange(len(points)), used))] = np.arange(len(points))
    return Index(mean, points, rank, many, shared, agreement)


def choose_pivots(vectors: DataFrame, most: int, threshold: float) -> dict[int, Index]:
    """The index of each dimension, from the SAMPLE_PER_PIVOT * `most` vectors (SAMPLE_ROWS at most) with the smallest hashes."""
    ordered = vectors.select("embedding", F.size("embedding").alias("dim"), F.xxhash64("node").alias("h"), "node").orderBy("h", "node")
    rows = ordered.limit(min(SAMPLE_PER_PIVOT * most, SAMPLE_ROWS)).select("dim", "embedding").toArrow()
    sizes = rows["dim"].to_numpy()
    return {dim: index_of(as_matrix(rows["embedding"].take(pa.array(np.flatnonzero(sizes == dim)))), most, threshold) for dim in np.unique(sizes).tolist()}


def nearest(x: np.ndarray, pivots: np.ndarray, many: int) -> np.ndarray:
    """The `many` nearest pivots of each row in order of nearness."""
    near = -(x @ pivots.T)
    k = min(many, len(pivots))
    if k == len(pivots):
        return np.argsort(near, axis=1, kind="stable")
    some = np.argpartition(near, k, axis=1)[:, :k]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(near, some, 1), axis=1, kind="stable"), 1)


def _describe(indexes: dict[int, Index]):
    """Permutation of each vector: its nearest pivots in order, as ranks by rarity; a dimension the sample lacks has one list."""

    @F.arrow_udf("array<int>")
    def describe(column: pa.Array) -> pa.Array:
        sizes = np.diff(column.offsets.to_numpy())
        out = [[0]] * len(column)
        for dim in np.unique(sizes).tolist():
            if dim in indexes:
                at = np.flatnonzero(sizes == dim)
                for i, row in zip(at, indexes[dim].order(as_matrix(column.take(pa.array(at)))).tolist(), strict=True):
                    out[i] = row
        return pa.array(out, pa.list_(pa.int32()))

    return describe


def _roots(links: np.ndarray) -> np.ndarray:
    """Least member of each row's group, from a symmetric matrix of links."""
    n = len(links)
    root = np.arange(n)
    while True:
        low = np.minimum(root, np.where(links, root[None, :], n).min(1))
        low = low[low]
        if (low == root).all():
            return root
        root = low


def candidates(near: np.ndarray, pivot: int, shared: int, agreement: float) -> np.ndarray:
    """Which pairs of one list agree enough in their orders, and share no pivot that is rarer than the list's."""
    n, many = near.shape
    nearness = np.zeros((n, int(near.max()) + 1), np.float32)
    np.put_along_axis(nearness, near, np.broadcast_to(np.arange(many, 0, -1, dtype=np.float32), near.shape), axis=1)
    seen = (nearness > 0).astype(np.float32)
    rarer = seen[:, :pivot]
    return (nearness @ nearness.T >= agreement) & (seen @ seen.T >= shared) & (rarer @ rarer.T == 0)


def _compare(threshold: float, needed: dict[int, tuple[int, float]]):
    """Links of one pair of blocks of one list; `needed`: shared pivots and agreement of candidates by dimension."""

    def run(table: pa.Table) -> pa.Table:
        pivot = table.column("pivot")[0].as_py()
        left, right = table.column("i")[0].as_py(), table.column("j")[0].as_py()
        nodes, weight, block = (table.column(c).to_numpy() for c in ("node", "copies", "block"))
        linked = candidates(as_matrix(table.column("near")).astype(np.int64), pivot, *needed.get(table.column("dim")[0].as_py(), (1, 1.0)))
        np.fill_diagonal(linked, False)
        if left != right:
            linked &= block[:, None] != block[None, :]
        x = unit_rows(as_matrix(table.column("embedding")))
        i, j = np.nonzero(np.triu(linked))
        if 8 * len(i) < len(nodes) ** 2:
            # Few candidates: their products alone.
            far = np.concatenate([np.einsum("ij,ij->i", x[p], x[q]) < threshold for p, q in zip(*(np.array_split(v, len(i) // 65536 + 1) for v in (i, j)), strict=True)])
            linked[i[far], j[far]] = linked[j[far], i[far]] = False
        else:
            linked &= (x @ x.T) >= threshold
        counts = linked @ weight
        hit = np.flatnonzero(counts)
        roots = _roots(linked[np.ix_(hit, hit)]) if len(hit) else hit
        return pa.table({"node": nodes[hit], "links": counts[hit], "root": nodes[hit][roots]}, schema=pa.schema([("node", pa.int64()), ("links", pa.int64()), ("root", pa.int64())]))

    return run


def near_vectors(embeddings: DataFrame, threshold: float = 0.93) -> DataFrame:
    """(vec_id, n_links, component_id, kept) for every row of (vec_id, embedding, label).

    Vectors link when their labels are equal and not null, their lengths equal and their cosine is at
    least `threshold`. Null, empty and zero vectors and those with null or non-finite components link
    with nothing, nor do rows with a null vec_id. Equal vectors of a label are compared once and count as linked copies. Of repeated
    vec_ids each row counts. Other columns are ignored; an empty table gives no rows.
    """
    rows = embeddings.select("vec_id", "embedding", "label")
    fit = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding"))
    good = rows.where(fit)
    keyed = good.select("vec_id", "label", "embedding", F.xxhash64("embedding").alias("d1"), F.hash("embedding").alias("d2"))
    key = ["label", "d1", "d2"]
    distinct = keyed.groupBy(*key).agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies"), F.first("embedding").alias("embedding"))
    # Numbered as they are written: ids may repeat.
    distinct = stored(distinct.withColumn("node", F.monotonically_increasing_id()), "vectors")
    vectors = distinct.select("label", "node", "copies", "embedding")
    indexes = choose_pivots(vectors, pivots_for(distinct.count()), threshold)
    describe = _describe(indexes)
    described = vectors.withColumn("dim", F.size("embedding")).withColumn("near", describe("embedding"))
    least = F.lit(1)
    for dim, index in indexes.items():
        least = F.when(F.col("dim") == dim, index.shared).otherwise(least)
    lists = F.slice(F.array_sort("near"), F.lit(1), F.greatest(F.lit(1), F.size("near") - (least - 1)))
    posted = stored(described.withColumn("pivot", F.explode(lists)), "postings")
    where = ["label", "dim", "pivot"]
    sizes = posted.groupBy(*where).agg(F.ceil(F.count("*") / BLOCK_ROWS).cast("int").alias("blocks"))
    placed = posted.join(sizes, where).withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    # Each row goes to the pairs (i, j), i <= j, of blocks that its own block is part of.
    paired = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    paired = paired.select(*where, F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "node", "copies", "near", "embedding")
    found = stored(paired.groupBy(*where, "i", "j").applyInArrow(_compare(threshold, {dim: (x.shared, x.agreement) for dim, x in indexes.items()}), "node long, links long, root long"), "links")
    discard(posted)
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    joined = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    classed = distinct.drop("embedding").join(links, "node", "left").join(joined, "node", "left")
    least = classed.where("component IS NOT NULL").groupBy("component").agg(F.min("rep").alias("least"))
    classed = classed.join(least, "component", "left").select(*key, (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component"))
    classed = stored(classed, "classes")
    discard(distinct, found, joined)
    copies = keyed.select("vec_id", *key).join(classed, key)
    alone = rows.where(~fit).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component"))
    out = copies.select("vec_id", "n_links", "component").unionByName(alone)
    return out.select("vec_id", "n_links", F.col("component").alias("component_id"), (F.col("vec_id") == F.col("component")).alias("kept"))
