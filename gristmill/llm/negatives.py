"""Hard-negative mining by angular triangle filtering.

Every vector keeps its angles to a few reference directions. By the triangle inequality of angles they bound the
angle between an anchor and a row from both sides; the cosines of those bounds, times both norms and rounded
outwards, bound the integer score. Only rows whose bounds overlap the window that an anchor still looks for get
integer scoring.

Rows are packed into blocks of vectors that lie close together, anchors into groups; every anchor group meets every
block of its dimension once for the positives and once for the negatives, spread over tasks. A task keeps the
first few finds of each anchor only, and the better these are, the narrower its windows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import discard, stored
from .pivots import as_matrix

#: Reference directions of a dimension, and the vectors with the least hashes that they are chosen from.
REFERENCES, SAMPLE_ROWS = 8, 4096
#: Rows of a block, anchors of a group, and anchors that are bounded and scored at once.
BLOCK_ROWS, ANCHOR_ROWS, CHUNK = 2048, 2048, 256
#: Radians by which bounds are widened: the arc cosine of a number next to 1 is off by 3e-8 at most.
SLACK = 1e-6
#: Squared norms beyond this don't take part: 100 times a score would not fit a long.
GREATEST = 2.0**62 / 100
#: Pairs are scored one by one if fewer than one in this many are wanted, else as a product of matrices.
SPARSE = 16
_MOST = np.iinfo(np.int64).max

_BLOCK = "dim int, n int, ids binary, labels binary, vectors binary, norms binary, angles binary"


def quantised(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component x taken as a double."""
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(x * scale))


def usable(embedding: Column) -> Column:
    """No null or non-finite component; a null vector isn't."""
    return F.coalesce(F.forall(embedding.cast("array<double>"), lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))), F.lit(False))


def choose_references(vectors: DataFrame, many: int) -> dict[int, np.ndarray]:
    """Per dimension up to `many` unit vectors, each as far from those before it as the bounded sample allows."""
    rows = vectors.select("q", F.size("q").alias("dim"), F.xxhash64("vec_id", "q").alias("h")).orderBy("h", "q").limit(SAMPLE_ROWS).toArrow()
    sizes, out = rows["dim"].to_numpy(), {}
    for dim in np.unique(sizes).tolist():
        x = as_matrix(rows["q"].take(pa.array(np.flatnonzero(sizes == dim)))).astype(np.float64) if dim else np.zeros((0, 0))
        norm = np.sqrt((x * x).sum(1))
        x = x[norm > 0] / norm[norm > 0, None]
        taken: list[int] = []
        near = np.full(len(x), -2.0)
        while len(taken) < min(many, len(x)):
            best = int(np.argmin(near))
            if taken and near[best] > 1 - 1e-9:
                break
            taken.append(best)
            near = np.maximum(near, x @ x[best])
        out[dim] = x[taken]
    return out


def angles_to(x: np.ndarray, references: np.ndarray) -> np.ndarray:
    """Angles of each row to each reference direction; a zero vector has a right angle to all."""
    norm = np.sqrt((x * x).sum(1, keepdims=True))
    return np.arccos(np.clip((x @ references.T) / np.where(norm == 0, 1, norm), -1, 1))


def _angles(references: dict[int, np.ndarray], many: int):
    """Stored angles of every vector, `many` each (right angles to directions that a dimension lacks)."""

    def run(column: pa.Array) -> pa.Array:
        sizes = np.diff(column.offsets.to_numpy())
        out = np.full((len(column), many), np.pi / 2)
        for dim in np.unique(sizes).tolist():
            points = references.get(dim, np.zeros((0, dim)))
            if dim and len(points):
                at = np.flatnonzero(sizes == dim)
                out[at, : len(points)] = angles_to(as_matrix(column.take(pa.array(at))).astype(np.float64), points)
        return pa.FixedSizeListArray.from_arrays(pa.array(out.ravel()), many).cast(pa.list_(pa.float64()))

    return F.arrow_udf(run, "array<double>")


def _pack(most: int):
    """Blocks of up to `most` rows of one dimension, in the order they come."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.diff(batch["q"].offsets.to_numpy())
            bounds = [0, *(np.flatnonzero(np.diff(sizes)) + 1).tolist(), len(sizes)]
            for a, b in ((i, min(i + most, hi)) for lo, hi in zip(bounds[:-1], bounds[1:], strict=True) for i in range(lo, hi, most)):
                part = batch.slice(a, b - a)
                q = as_matrix(part["q"]).astype("<i4") if sizes[a] else np.zeros((b - a, 0), "<i4")
                angles = as_matrix(part["angles"])
                norms = np.sqrt((q.astype(np.float64) ** 2).sum(1))
                block = (int(sizes[a]), b - a, part["vec_id"].to_numpy().astype("<i8"), part["label"].to_numpy().astype("<i8"), q, norms, angles)
                yield pa.RecordBatch.from_pydict(
                    {
                        name: pa.array([x.tobytes() if isinstance(x, np.ndarray) else x], kind)
                        for name, x, kind in zip(("dim", "n", "ids", "labels", "vectors", "norms", "angles"), block, (pa.int32(), pa.int32(), *[pa.binary()] * 5), strict=True)
                    }
                )

    return run


class Vectors:
    """The vectors of row k of packed blocks."""

    def __init__(self, batch: pa.RecordBatch, k: int, prefix: str = ""):
        n = batch.column(f"{prefix}n")[k].as_py()
        read = lambda name, kind: np.frombuffer(batch.column(prefix + name)[k].as_buffer(), kind)
        self.ids, self.labels, self.norms = read("ids", "<i8"), read("labels", "<i8"), read("norms", "<f8")
        self.vectors, self.angles = read("vectors", "<i4").reshape(n, -1), read("angles", "<f8").reshape(n, -1)


def score_bounds(a_angles: np.ndarray, a_norms: np.ndarray, x_angles: np.ndarray, x_norms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest score of every anchor with every row, rounded outwards."""
    least = np.zeros((len(a_angles), len(x_angles)))
    most = np.full(least.shape, np.pi)
    for k in range(a_angles.shape[1]):
        mine, theirs = a_angles[:, k, None], x_angles[None, :, k]
        np.maximum(least, np.abs(mine - theirs), out=least)
        both = mine + theirs
        np.minimum(most, np.minimum(both, 2 * np.pi - both), out=most)
    scale = a_norms[:, None] * x_norms[None, :]
    low = scale * np.cos(np.minimum(most + SLACK, np.pi))
    high = scale * np.cos(np.maximum(least - SLACK, 0))
    return np.floor(low - scale * 1e-12) - 1, np.ceil(high + scale * 1e-12) + 1


def greatest_scores(a_angles: np.ndarray, a_norms: np.ndarray, block: Vectors) -> np.ndarray:
    """What no row of a block can surpass, for every anchor: from the range of the block's angles and norms alone."""
    low, high = block.angles.min(0), block.angles.max(0)
    apart = np.maximum(0, np.maximum(low - a_angles, a_angles - high)).max(1, initial=0)
    cosine = np.cos(np.maximum(apart - SLACK, 0))
    scale = a_norms * np.where(cosine > 0, block.norms.max(), block.norms.min())
    return np.ceil(scale * cosine + scale * 1e-12) + 1


def scores(a: np.ndarray, x: np.ndarray, greatest: float) -> np.ndarray:
    """Exact inner products of all pairs; by doubles while no partial sum can leave their whole numbers."""
    if greatest < 2.0**53:
        return np.rint(a.astype(np.float64) @ x.astype(np.float64).T).astype(np.int64)
    return a.astype(np.int64) @ x.astype(np.int64).T


class Best:
    """The first `many` (score, id) of each place: greatest scores first, ties by the smaller id, equal pairs once."""

    def __init__(self, places: int, many: int):
        self.many = many
        self.at = self.score = self.id = np.zeros(0, np.int64)
        self.least = np.full(places, -_MOST)
        self.last = np.full(places, _MOST)

    def add(self, at: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        if not len(at):
            return
        at, score, ids = (np.concatenate(x) for x in ((self.at, at), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, -score, at))
        at, score, ids = at[order], score[order], ids[order]
        new = np.ones(len(at), bool)
        new[1:] = (at[1:] != at[:-1]) | (score[1:] != score[:-1]) | (ids[1:] != ids[:-1])
        at, score, ids = at[new], score[new], ids[new]
        place = np.arange(len(at)) - np.searchsorted(at, at)
        full = place == self.many - 1
        self.least[at[full]], self.last[at[full]] = score[full], ids[full]
        keep = place < self.many
        self.at, self.score, self.id = at[keep], score[keep], ids[keep]

    def wanted(self, places: np.ndarray, score: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Which scores (places x rows) would come among the first."""
        least = self.least[places, None]
        return (score > least) | ((score == least) & (ids[None, :] < self.last[places, None]))


def _meet(anchors: Vectors, rows: Vectors, low: np.ndarray, high: np.ndarray, same: bool):
    """Scores of the pairs that can lie in their anchor's window, chunk by chunk: (anchors, rows, which pairs, scores).

    `low` and `high` are functions of the anchors' numbers, asked anew for each chunk.
    """
    everyone = np.arange(len(anchors.ids))
    top = greatest_scores(anchors.angles, anchors.norms, rows)
    for first in range(0, len(everyone), CHUNK):
        a = everyone[first : first + CHUNK]
        a = a[(top[a] >= low(a)) & (low(a) <= high(a))]
        x = np.flatnonzero(np.isin(rows.labels, anchors.labels[a])) if same else np.arange(len(rows.ids))
        if not len(a) or not len(x):
            continue
        least, most = score_bounds(anchors.angles[a], anchors.norms[a], rows.angles[x], rows.norms[x])
        wanted = (most >= low(a)[:, None]) & (least <= high(a)[:, None])
        equal = anchors.labels[a][:, None] == rows.labels[x][None, :]
        wanted &= equal & (anchors.ids[a][:, None] != rows.ids[x][None, :]) if same else ~equal
        some, any_row = wanted.any(1), wanted.any(0)
        a, x, wanted = a[some], x[any_row], wanted[np.ix_(some, any_row)]
        if not wanted.size:
            continue
        greatest = float(anchors.norms[a].max() * rows.norms[x].max())
        if wanted.sum() * SPARSE < wanted.size:
            i, j = np.nonzero(wanted)
            kind = np.float64 if greatest < 2.0**53 else np.int64
            found = np.zeros(wanted.shape, np.int64)
            for part in np.array_split(np.arange(len(i)), len(i) // 65536 + 1):
                pair = np.einsum("ij,ij->i", anchors.vectors[a[i[part]]].astype(kind), rows.vectors[x[j[part]]].astype(kind))
                found[i[part], j[part]] = np.rint(pair).astype(np.int64)
        else:
            found = scores(anchors.vectors[a], rows.vectors[x], greatest)
        yield a, x, wanted, found


def _finds(state: Best | None, group: int | None) -> pa.RecordBatch:
    n = 0 if state is None else len(state.at)
    empty = np.zeros(0, np.int64)
    at, score, ids = (empty, empty, empty) if state is None else (state.at, state.score, state.id)
    return pa.RecordBatch.from_pydict({"grp": pa.array(np.full(n, group or 0)), "place": pa.array(at), "score": pa.array(score), "id": pa.array(ids)})


def _mine(state_of, finds):
    """Over joined pairs of an anchor group and a block: `state_of` starts a group, `finds` adds what a block has for it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group = anchors = state = None
        for batch in batches:
            for k in range(batch.num_rows):
                if (this := batch.column("grp")[k].as_py()) != group:
                    yield _finds(state, group)
                    group, anchors = this, Vectors(batch, k, "a_")
                    state = state_of(batch, k, anchors)
                finds(state, anchors, Vectors(batch, k))
        yield _finds(state, group)

    return run


def _positives(many: int):
    def start(batch: pa.RecordBatch, k: int, anchors: Vectors) -> Best:
        return Best(len(anchors.ids), many)

    def add(best: Best, anchors: Vectors, rows: Vectors) -> None:
        low, high = (lambda a: best.least[a].astype(np.float64)), (lambda a: np.full(len(a), np.inf))
        for a, x, wanted, found in _meet(anchors, rows, low, high, True):
            i, j = np.nonzero(wanted & best.wanted(a, found, rows.ids[x]))
            best.add(a[i], found[i, j], rows.ids[x[j]])

    return _mine(start, add)


def _negatives(many: int, slots: int, window: tuple[int, int]):
    """Place anchor * slots + k holds the negatives of an anchor's positive k, whose scores are in low .. high."""

    def start(batch: pa.RecordBatch, k: int, anchors: Vectors) -> Best:
        best = Best(len(anchors.ids) * slots, many)
        best.low, best.high = np.full(len(best.least), _MOST), np.full(len(best.least), -_MOST)
        listed = batch.column("positives")[k].values
        place, score = (listed.field(c).to_numpy().astype(np.int64) for c in ("place", "score"))
        place = place * slots + listed.field("k").to_numpy()
        # window[0] * p <= 100 * n <= window[1] * p in whole numbers; scores below 0 have no window.
        low, high = -((-window[0] * score) // 100), (window[1] * score) // 100
        some = low <= high
        best.low[place[some]], best.high[place[some]] = low[some], high[some]
        return best

    def add(best: Best, anchors: Vectors, rows: Vectors) -> None:
        low = lambda a: np.maximum(best.low, best.least).reshape(-1, slots)[a].min(1).astype(np.float64)
        high = lambda a: best.high.reshape(-1, slots)[a].max(1).astype(np.float64)
        for a, x, wanted, found in _meet(anchors, rows, low, high, False):
            for k in range(slots):
                place = a * slots + k
                i, j = np.nonzero(wanted & (found >= best.low[place, None]) & (found <= best.high[place, None]) & best.wanted(place, found, rows.ids[x]))
                best.add(place[i], found[i, j], rows.ids[x[j]])

    return _mine(start, add)


_FINDS = "grp long, place long, score long, id long"


def _first(finds: DataFrame, many: int) -> DataFrame:
    """The first `many` finds of each place over all tasks, numbered from 1."""
    order = Window.partitionBy("grp", "place").orderBy(F.col("score").desc(), F.col("id"))
    return finds.withColumn("r", F.dense_rank().over(order)).where(F.col("r") <= many).distinct()


def hard_negatives(
    embeddings: DataFrame, anchors: Column | None = None, positives: int = 5, negatives: int = 3, window: tuple[int, int] = (50, 95), scale: int = 256
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) from rows of (vec_id, embedding, label).

    Components become floor(scale * x); scores are integer inner products; higher scores come first, ties by the smaller
    vec_id. Anchors are the rows where `anchors` holds (default: vec_id divisible by 50). An anchor's positives are its first
    `positives` rows of the same label and another vec_id; for each, the first `negatives` rows of other labels whose
    score is window[0] to window[1] percent of the positive's are returned, numbered from 1. A positive without any has no
    row. Rows with a null id, label or vector, with null or non-finite components, or whose scores would not fit a long
    take no part; vectors of unlike lengths are not compared; a zero vector scores 0. Rows that agree in id and score with
    another one count once; anchors that share an id but not the vector or label are mined each. Other columns are
    ignored; an empty table gives no rows.
    """
    rows = embeddings.select("vec_id", "embedding", F.col("label").cast("long").alias("label"))
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable(F.col("embedding")))
    rows = rows.select("vec_id", "label", quantised(F.col("embedding"), scale).alias("q"))
    squares = F.aggregate("q", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    rows = rows.where(squares < GREATEST).withColumn("q", F.col("q").cast("array<int>"))
    references = choose_references(rows, REFERENCES)
    known = rows.withColumn("angles", _angles(references, REFERENCES)("q"))
    nearest = F.array_min("angles")
    order = ["dim", "label", "cell", "near", "vec_id"]
    known = known.select("*", F.size("q").alias("dim"), F.array_position("angles", nearest).alias("cell"), nearest.alias("near"))
    blocks = stored(known.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "q", "angles").mapInArrow(_pack(BLOCK_ROWS), _BLOCK), "blocks")
    chosen = known.where(F.col("vec_id") % 50 == 0 if anchors is None else anchors).dropDuplicates(["vec_id", "label", "q"])
    groups = chosen.repartitionByRange(*order).sortWithinPartitions(*order).select("vec_id", "label", "q", "angles").mapInArrow(_pack(ANCHOR_ROWS), _BLOCK)
    groups = groups.select("dim", F.monotonically_increasing_id().alias("grp"), *(F.col(c).alias(f"a_{c}") for c in ("n", "ids", "labels", "vectors", "norms", "angles")))
    groups = stored(groups, "anchors")
    spark = embeddings.sparkSession
    salts = max(1, min(blocks.count(), 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    dealt = blocks.withColumn("salt", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(salts)))

    def meeting(groups: DataFrame) -> DataFrame:
        """Every anchor group with every block of its dimension; all blocks of one salt in one task, a group after the other.

        Spark takes the groups for no larger than before they are repeated for each salt, and would broadcast them through the driver.
        """
        return groups.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long")))).join(dealt.hint("merge"), ["dim", "salt"]).drop("salt")

    best = stored(_first(meeting(groups).mapInArrow(_positives(positives), _FINDS), positives), "positives")
    # Equal finds count once, so ranks are the positives' numbers.
    listed = best.groupBy("grp").agg(F.collect_list(F.struct("place", (F.col("r") - 1).alias("k"), "score")).alias("positives"))
    mined = _first(meeting(groups.join(listed, "grp")).mapInArrow(_negatives(negatives, positives, window), _FINDS), negatives)
    mined = mined.select("grp", (F.col("place") % positives + 1).cast("int").alias("r"), F.floor(F.col("place") / positives).alias("place"), F.col("r").alias("rank"), F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = groups.select("grp", F.posexplode(_ids("a_ids")).alias("at", "anchor_id")).select("grp", F.col("at").cast("long").alias("place"), "anchor_id")
    pairs = best.join(names.hint("merge"), ["grp", "place"]).select("grp", "place", "r", "anchor_id", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    return pairs.join(mined, ["grp", "place", "r"]).select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")


def _ids(column: str) -> Column:
    """Packed ids as an array."""
    return F.arrow_udf(lambda c: pa.array([np.frombuffer(x, "<i8") for x in c.to_pylist()], pa.list_(pa.int64())), "array<long>")(F.col(column))
