"""Quality rules as a short-circuit cascade.

Each rule's cost and selectivity are estimated on a bounded sample; rules are then ordered by
rejections per unit of cost, and a text that one rule rejects is not measured by the later ones. The
order changes the work, never the verdict. The DIGEST figures are wanted of every text, so they are measured
first and cost the rules nothing; the base rules use nothing else.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import chunks
from .features import TextBlock


@dataclass(frozen=True)
class Rule:
    """`rejects` takes a TextBlock and gives one flag per text."""

    name: str
    rejects: Callable[[TextBlock], np.ndarray]


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


BASE_RULES = (
    Rule("too_few_words", lambda b: b.n_words() < 20),
    Rule("repeated_windows", lambda b: 100 * b.n_repeat_words() > 30 * b.n_words()),
)
EXTRA_RULES = (
    Rule("symbols", lambda b: _share(b.n_symbols(), b.word_chars()) > 0.03),
    Rule("shouting", lambda b: _share(b.n_upper(), b.n_chars()) > 0.30),
    Rule("duplicate_lines", lambda b: _share(b.n_dup_lines(), b.n_lines()) > 0.50),
    Rule("stutter", lambda b: _share(b.n_same_next(), b.n_words()) > 0.30),
    Rule("few_letters", lambda b: _share(b.n_letters(), b.word_chars()) < 0.45),
    Rule("endless_words", lambda b: _share(b.word_chars(), b.n_words()) > 30),
)
DIGEST = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def estimate(documents: DataFrame, rules: tuple[Rule, ...], sample_rows: int = 400, text: str = "text", base: tuple[Rule, ...] = ()) -> list[tuple[str, float, float]]:
    """(rule, seconds per text, share rejected) on the `sample_rows` rows with the least hashes, measured in one task.

    As in the cascade, the digest is there already and only texts that the `base` rules pass are measured; a rule's seconds
    are what it adds to that. Only the figures reach the driver. Without rows every rule gets cost 1 and selectivity 0.
    """
    names = [r.name for r in rules]

    def measure(batches):
        spent, rejected, seen = np.zeros(len(rules)), np.zeros(len(rules)), 0
        for batch in batches:
            for _, _, data, offsets in chunks(batch.column(0)):
                block = TextBlock(data, offsets)
                digest_of(block)
                block = block.subset(np.flatnonzero(cascade(block, base) < 0))
                seen += block.n
                for k, rule in enumerate(rules):
                    own = block.subset(np.arange(block.n))
                    began = time.perf_counter()
                    rejected[k] += rule.rejects(own).sum()
                    spent[k] += time.perf_counter() - began
        yield pa.RecordBatch.from_pydict({"rule": names, "spent": spent, "rejected": rejected, "seen": [seen] * len(rules)})

    some = documents.orderBy(F.xxhash64(*(documents[f"`{c}`"] for c in documents.columns if not isinstance(documents.schema[c].dataType, T.MapType)))).select(F.col(text).alias("text")).limit(sample_rows)
    rows = some.coalesce(1).mapInArrow(measure, "rule string, spent double, rejected double, seen long").collect()
    by = {r["rule"]: r for r in rows}
    return [(n, by[n]["spent"] / max(by[n]["seen"], 1) if n in by else 1.0, by[n]["rejected"] / max(by[n]["seen"], 1) if n in by else 0.0) for n in names]


def order_rules(rules: tuple[Rule, ...], figures: list[tuple[str, float, float]]) -> tuple[Rule, ...]:
    """Most rejections per cost first; equal ones keep their order."""
    gain = {name: rejected / max(cost, 1e-9) for name, cost, rejected in figures}
    return tuple(sorted(rules, key=lambda r: -gain[r.name]))


def digest_of(block: TextBlock) -> list[np.ndarray]:
    return [getattr(block, n)() for n in DIGEST]


def cascade(block: TextBlock, rules: tuple[Rule, ...]) -> np.ndarray:
    """Index of the first rule that rejects each text, or -1; a rejected text is cut from what later rules see."""
    verdict = np.full(block.n, -1, np.int64)
    alive = np.arange(block.n)
    for k, rule in enumerate(rules):
        if not len(alive):
            break
        bad = rule.rejects(block)
        verdict[alive[bad]] = k
        if bad.any():
            left = np.flatnonzero(~bad)
            alive, block = alive[left], block.subset(left)
    return verdict


def apply_rules(text: Column | str, rules: tuple[Rule, ...], base: tuple[Rule, ...] = ()) -> Column:
    """Struct of (the DIGEST measurements, base_failed, kept, failed_rule) of a whole text.

    `base` rules decide base_failed; a text they reject isn't measured by `rules`. failed_rule names
    the first rejecting rule in the order given, null if kept. A null or empty text has no words.
    """
    fields = [pa.field(n, pa.int64()) for n in DIGEST] + [pa.field("base_failed", pa.bool_()), pa.field("kept", pa.bool_()), pa.field("failed_rule", pa.string())]
    kind = ", ".join(f"{n}: long" for n in DIGEST) + ", base_failed: boolean, kept: boolean, failed_rule: string"

    @F.arrow_udf(f"struct<{kind}>")
    def judge(column: pa.Array) -> pa.Array:
        parts: list[list[np.ndarray]] = []
        for _, _, data, offsets in chunks(column):
            block = TextBlock(data, offsets)
            digest = digest_of(block)
            first = cascade(block, base)
            passed = np.flatnonzero(first < 0)
            found = cascade(block.subset(passed) if len(passed) < block.n else block, rules)
            verdict = first.copy()
            verdict[passed] = np.where(found >= 0, found + len(base), -1)
            parts.append([*digest, first >= 0, verdict < 0, verdict])
        names = np.array([*(r.name for r in (*base, *rules)), None], object)
        joined = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5 + [np.zeros(0, bool)] * 2 + [np.zeros(0, np.int64)]
        arrays = [pa.array(x) for x in joined[:-1]] + [pa.array(names[joined[-1]], pa.string())]
        return pa.StructArray.from_arrays(arrays, fields=fields)

    return judge(F.col(text) if isinstance(text, str) else text)


def quality_cascade(documents: DataFrame, text: str = "text", sample_rows: int = 400, out: str = "quality") -> DataFrame:
    """The documents with a struct column `out` of measurements and verdict, rules ordered by estimate.

    All rows and columns stay (a column named `out` is replaced); filter on `out`.kept to apply it.
    Repeated rows are judged alike; an empty table stays empty.
    """
    extra = order_rules(EXTRA_RULES, estimate(documents, EXTRA_RULES, sample_rows, text, BASE_RULES))
    base = BASE_RULES
    return documents.withColumn(out, apply_rules(text, extra, base))
