"""Quality classifier: a generalised additive model with pairwise interactions.

Each feature has bins at quantiles and a lookup table of additive scores, learned by cyclic boosting
of shallow trees: feature after feature, a small tree over its bins is fitted to the residual and
added at a low rate. Then the most useful pairs of features get small two-way tables the same way.
A text's score is the logistic of the tables' entries for its bins.
"""

from __future__ import annotations

from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import chunks, release_memory
from .features import FEATURES, TextBlock, feature_matrix

#: Most labelled rows that a model is fitted on (smallest hashes of doc_id first).
FIT_ROWS = 20_000


@dataclass
class AdditiveModel:
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]
    intercept: float

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of label 1 for each row."""
        total = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            total += table[np.searchsorted(edges, x[:, j], "right")]
        for a, b, edges_a, edges_b, table in self.pairs:
            total += table[np.searchsorted(edges_a, x[:, a], "right"), np.searchsorted(edges_b, x[:, b], "right")]
        return 1 / (1 + np.exp(-total))


def _quantile_edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.linspace(0, 1, bins + 1)[1:-1]))


def _tree_on_bins(g: np.ndarray, h: np.ndarray, n: np.ndarray, leaves: int, least: int) -> np.ndarray:
    """Step values of a greedy tree with at most `leaves` leaves over ordered bins (Newton leaf values)."""
    cuts = [0, len(g)]
    G, H, N = (np.concatenate(([0.0], np.cumsum(v))) for v in (g, h, n))

    def gain(a: int, b: int) -> float:
        return (G[b] - G[a]) ** 2 / (H[b] - H[a] + 1.0)

    for _ in range(leaves - 1):
        best, place = 1e-9, None
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            for m in range(a + 1, b):
                if N[m] - N[a] >= least and N[b] - N[m] >= least and (d := gain(a, m) + gain(m, b) - gain(a, b)) > best:
                    best, place = d, m
        if place is None:
            break
        cuts = sorted([*cuts, place])
    step = np.zeros(len(g))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        step[a:b] = (G[b] - G[a]) / (H[b] - H[a] + 1.0)
    return step


def fit_additive(
    x: np.ndarray, y: np.ndarray, rounds: int = 120, rate: float = 0.15, bins: int = 24, leaves: int = 3, n_pairs: int = 4, pair_rounds: int = 30, pair_bins: int = 6, least: int = 5
) -> AdditiveModel:
    """Fit on feature rows x and labels y (0 or 1). With one class or no rows, a constant near the mean (0.5 without rows)."""
    n, k = x.shape
    mean = (y.sum() + 0.5) / (n + 1)
    model = AdditiveModel([np.zeros(0)] * k, [np.zeros(1)] * k, [], float(np.log(mean / (1 - mean))))
    if n == 0 or y.min() == y.max():
        return model
    model.edges = [_quantile_edges(x[:, j], bins) for j in range(k)]
    binned = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(model.edges)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    total = np.full(n, model.intercept)
    for _ in range(rounds):
        for j in range(k):
            p = 1 / (1 + np.exp(-total))
            size = len(model.tables[j])
            step = rate * _tree_on_bins(np.bincount(binned[j], y - p, size), np.bincount(binned[j], p * (1 - p), size), np.bincount(binned[j], minlength=size), leaves, least)
            model.tables[j] = model.tables[j] + step
            total += step[binned[j]]
    coarse = [_quantile_edges(x[:, j], pair_bins) for j in range(k)]
    cells = [np.searchsorted(e, x[:, j], "right") for j, e in enumerate(coarse)]
    p = 1 / (1 + np.exp(-total))

    def sums(a: int, b: int, p: np.ndarray):
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        at = cells[a] * shape[1] + cells[b]
        return at, shape, np.bincount(at, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(at, p * (1 - p), shape[0] * shape[1]).reshape(shape)

    def usefulness(pair: tuple[int, int]) -> float:
        _, _, g, h = sums(*pair, p)
        return float((g**2 / (h + 1.0)).sum() - (g.sum(0) ** 2 / (h.sum(0) + 1.0)).sum() - (g.sum(1) ** 2 / (h.sum(1) + 1.0)).sum())

    chosen = sorted(combinations(range(k), 2), key=usefulness, reverse=True)[:n_pairs]
    tables = {pair: np.zeros((len(coarse[pair[0]]) + 1, len(coarse[pair[1]]) + 1)) for pair in chosen}
    for _ in range(pair_rounds):
        for pair in chosen:
            p = 1 / (1 + np.exp(-total))
            at, _, g, h = sums(*pair, p)
            step = rate * _quadrants(g, h)
            tables[pair] += step
            total += step.ravel()[at]
    model.pairs = [(a, b, coarse[a], coarse[b], tables[a, b]) for a, b in chosen]
    return model


def _quadrants(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """A depth-two tree over a two-way table: the pair of cuts with most gain, four leaf values."""
    G, H = (np.pad(v, ((1, 0), (1, 0))).cumsum(0).cumsum(1) for v in (g, h))
    best, out = -1.0, np.zeros_like(g)
    for i in range(1, g.shape[0]):
        for j in range(1, g.shape[1]):
            parts = [(slice(a, b), slice(c, d)) for a, b in ((0, i), (i, g.shape[0])) for c, d in ((0, j), (j, g.shape[1]))]
            values = [(G[r.stop, s.stop] - G[r.start, s.stop] - G[r.stop, s.start] + G[r.start, s.start], H[r.stop, s.stop] - H[r.start, s.stop] - H[r.stop, s.start] + H[r.start, s.start]) for r, s in parts]
            if (gain := sum(u * u / (v + 1.0) for u, v in values)) > best:
                best, out = gain, np.zeros_like(g)
                for part, (u, v) in zip(parts, values, strict=True):
                    out[part] = u / (v + 1.0)
    return out


def _matrix(column: pa.Array) -> np.ndarray:
    parts = [feature_matrix(TextBlock(data, offsets)) for _, _, data, offsets in chunks(column)]
    release_memory()
    return np.concatenate(parts) if parts else np.zeros((0, len(FEATURES)))


def text_features(text: Column | str) -> Column:
    """FEATURES of a whole text as array<double>; a null text counts as empty (all 0)."""

    @F.arrow_udf("array<double>")
    def measure(column: pa.Array) -> pa.Array:
        x = _matrix(column)
        return pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * len(FEATURES), pa.int32()), pa.array(x.ravel(), pa.float64()))

    return measure(F.col(text) if isinstance(text, str) else text)


def held_out(doc_id: Column | str = "doc_id", parts: int = 5) -> Column:
    """True where crc32 of doc_id as text leaves no remainder; false for a null id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % parts == 0, F.lit(False))


def fit_quality(documents: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, label: str = "quality", **settings) -> AdditiveModel:
    """A model of `label` from the labelled documents outside the held-out part.

    At most `fit_rows` labelled ids are used (a documented bound, so they and their features may be
    broadcast and collected); they are the ones with the smallest hashes. Null labels and labels of
    unknown documents don't count; an id labelled twice counts by its greater label, and of documents
    with one id the one with the greatest features counts.
    """
    chosen = (
        labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.max(label).alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(fit_rows)
    )
    pairs = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", F.col("y").cast("double").alias("y"), text_features("text").alias("x"))
    rows = pairs.groupBy("doc_id").agg(F.max(F.struct("y", "x")).alias("r")).select("r.y", "r.x").toArrow()
    if not rows.num_rows:
        return fit_additive(np.zeros((0, len(FEATURES))), np.zeros(0))
    y = rows["y"].to_numpy()
    x = rows["x"].combine_chunks().flatten().to_numpy().reshape(len(y), -1)
    order = np.lexsort((*x.T[::-1], y))  # the same model whatever order the rows come in
    return fit_additive(x[order], y[order], **settings)


def quality_score(text: Column | str, model: AdditiveModel) -> Column:
    """Probability of label 1 of a whole text, in double."""

    @F.arrow_udf("double")
    def score(column: pa.Array) -> pa.Array:
        return pa.array(model.score(_matrix(column)), pa.float64())

    return score(F.col(text) if isinstance(text, str) else text)


def keep_quality(documents: DataFrame, labels: DataFrame, least: float = 0.3, fit_rows: int = FIT_ROWS) -> DataFrame:
    """The documents whose score is at least `least`, with their own columns only."""
    model = fit_quality(documents, labels, fit_rows)
    return documents.where(quality_score("text", model) >= least)
