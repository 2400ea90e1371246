"""Mixing sources to target weights by iterative proportional fitting, with DataFrame functions only.

Token weights of the cells (source, language, topic) are raked until their marginals meet the
targets; each document is then kept with its cell's calibrated probability.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stored

MARGINS = ("source", "lang", "topic")
#: Exponent by which each margin's natural shares are tempered to get its target weights.
TEMPER = {"source": 0.7, "lang": 0.9, "topic": 1.0}
ROUNDS = 8
#: Share of all tokens that a mix without a budget keeps at least.
KEPT_SHARE = 0.8
#: Budget that lets the largest factor alone set the scale: targets are met exactly, whatever is lost.
EXACT = "exact"


def word_count(text: Column) -> Column:
    """Words between ASCII white space (long); null counts as empty."""
    parts = F.split(F.coalesce(text, F.lit("")), "[ \\t\\n\\x0B\\f\\r]+")
    n = F.size(parts)
    return (n - F.when(F.element_at(parts, 1) == "", 1).otherwise(0) - F.when((n > 1) & (F.element_at(parts, -1) == ""), 1).otherwise(0)).cast("long")


#: Terms of each topic; the topic whose terms occur most often in a text is its topic.
TOPICS = {
    "law": ("icense", "opyright", "arranty", "iabilit"),
    "contact": ("@", "hone:", "mail:"),
    "web": ("://", "www.", ".com"),
    "table": ("|", "\t", ";"),
    "markup": ("###", "%%%", "***", "$$$", "&&&", "</"),
}
#: Topic of a text in which no term occurs.
NO_TOPIC = "prose"


def term_count(text: Column, term: str) -> Column:
    """Occurrences of a term in a whole text that don't overlap, from the bytes that taking them out saves."""
    return (F.octet_length(text) - F.octet_length(F.replace(text, F.lit(term), F.lit("")))) / F.lit(len(term.encode()))


def topic_of(text: Column, topics: dict[str, tuple[str, ...]] | None = None) -> Column:
    """The topic whose terms occur most often in the whole text; the first of equal ones, NO_TOPIC without any."""
    t = F.coalesce(text, F.lit(""))
    scores = [(name, sum((term_count(t, x) for x in terms[1:]), term_count(t, terms[0]))) for name, terms in (TOPICS if topics is None else topics).items()]
    ranked = F.array(*(F.struct(score.alias("n"), F.lit(-k).alias("k"), F.lit(name).alias("name")) for k, (name, score) in enumerate(scores)), F.struct(F.lit(0.0).alias("n"), F.lit(1).alias("k"), F.lit(NO_TOPIC).alias("name")))
    return F.array_max(ranked)["name"]


def draw(doc_id: Column) -> Column:
    """A number in [0, 1) that depends on the id alone; a null id counts as the empty string."""
    return F.conv(F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit(""))), 1, 8), 16, 10).cast("double") / 4294967296.0


def tempered_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """(level, target): natural token shares of a margin raised to `power` and made to sum to 1."""
    sums = cells.groupBy(margin).agg(F.sum("n").alias("n"))
    raised = F.pow(F.col("n").cast("double"), F.lit(power))
    return sums.select(F.col(margin).alias("level"), (raised / F.sum(raised).over(Window.partitionBy())).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = ROUNDS) -> DataFrame:
    """The cells with their raked share `w`: each round scales every margin to its targets in turn.

    `cells` has one row per combination of levels with its tokens `n`; levels without a target keep
    no weight, and targets without a cell can't be met (the rest is scaled up at the end).
    """
    out = cells.withColumn("w", F.col("n") / F.sum("n").over(Window.partitionBy()))
    for m, t in targets.items():
        named = t.select(F.col("level").alias(m), F.col("target").alias(f"t_{m}"))
        out = out.join(named, m, "left").na.fill(0.0, [f"t_{m}"])
    for _ in range(rounds):
        for m in targets:
            have = F.sum("w").over(Window.partitionBy(m))
            out = out.withColumn("w", F.when(have > 0, F.col("w") * F.col(f"t_{m}") / have).otherwise(0.0))
    return out.withColumn("w", F.col("w") / F.sum("w").over(Window.partitionBy()))


def _levels(documents: DataFrame, topics: dict[str, tuple[str, ...]] | None) -> dict[str, Column]:
    """Each document's level of every margin; null source or lang is the level ''."""
    return {
        "source": F.coalesce(documents["source"].cast("string"), F.lit("")),
        "lang": F.coalesce(documents["lang"].cast("string"), F.lit("")),
        "topic": topic_of(documents["text"], topics),
    }


def _described(documents: DataFrame, topics: dict[str, tuple[str, ...]] | None, tokens: str | None) -> DataFrame:
    """Levels and tokens of every document; texts are read once, what follows needs these columns only."""
    levels = _levels(documents, topics)
    n = word_count(documents["text"]) if tokens is None else F.coalesce(documents[tokens].cast("long"), F.lit(0))
    return stored(documents.select("doc_id", *(levels[m].alias(m) for m in MARGINS), n.alias("n_tokens")), "mix-rows")


def _filled(raked: DataFrame, budget: Column) -> DataFrame:
    """The cells with the `level` by which their factors are multiplied so that the tokens kept, none twice, add up to `budget`.

    Cells are filled in the order of their factors: the first one whose probability stays within 1, once all
    before it are kept whole, sets the level of the rest; later ones give lower levels. Without one (budget of
    all tokens) level is null.
    """
    order = Window.partitionBy().orderBy(F.desc("factor"), *MARGINS)
    before, rest = order.rowsBetween(Window.unboundedPreceding, -1), order.rowsBetween(0, Window.unboundedFollowing)
    level = (budget - F.coalesce(F.sum("n").over(before), F.lit(0))) / F.sum("w").over(rest)
    tried = raked.withColumn("level", level)
    fits = F.when(F.col("level") * F.col("factor") <= 1, F.col("level"))
    return tried.withColumn("level", F.max(fits).over(Window.partitionBy()))


def _cell_chances(rows: DataFrame, targets: dict[str, DataFrame] | None, budget: float | str | None, rounds: int) -> DataFrame:
    """(source, lang, topic, probability) of every cell that has tokens."""
    cells = rows.groupBy(*MARGINS).agg(F.sum("n_tokens").alias("n")).where(F.col("n") > 0)
    wanted = {m: (targets or {}).get(m) or tempered_targets(cells, m, TEMPER[m]) for m in MARGINS}
    raked = rake(cells, wanted, rounds).withColumn("factor", F.col("w") / F.col("n"))
    exact = F.col("factor") / F.max("factor").over(Window.partitionBy())
    if budget == EXACT:
        scaled = exact
    else:
        tokens = F.lit(KEPT_SHARE) * F.sum("n").over(Window.partitionBy()) if budget is None else F.lit(float(budget))
        raked = _filled(raked, tokens)
        scaled = F.when(F.col("factor") > 0, F.least(F.lit(1.0), F.coalesce(F.col("level") * F.col("factor"), F.lit(1.0)))).otherwise(0.0)
        scaled = F.greatest(scaled, exact) if budget is None else scaled
    return stored(raked.select(*MARGINS, scaled.alias("probability")), "mix-cells")


def mix(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float | str | None = None, rounds: int = ROUNDS, topics: dict[str, tuple[str, ...]] | None = None, tokens: str | None = None) -> DataFrame:
    """(doc_id, source, lang, topic, n_tokens, probability, kept) for every document.

    `targets` maps a margin to (level, target) rows; a margin left out gets tempered natural shares.
    `budget` is the number of tokens wanted. Cells whose probability would exceed 1 are kept whole and the
    others are scaled up to fill it. EXACT is the most that meets the targets with no document twice, so the
    largest factor alone sets the scale; by default that holds too, but KEPT_SHARE of the tokens is kept at
    least, so that a rare cell doesn't scale down all others.
    `topics` gives terms of topics in place of TOPICS; `tokens` names a column of token counts (of another stage, say) to
    use in place of words. Null source or lang is the level ''; null text has no tokens; documents of a cell without
    tokens have probability 0. Rows with one doc_id are drawn alike. Other columns are ignored.
    """
    rows = _described(documents, topics, tokens)
    joined = rows.join(_cell_chances(rows, targets, budget, rounds), list(MARGINS), "left")
    p = F.coalesce("probability", F.lit(0.0))
    return joined.select("doc_id", *MARGINS, "n_tokens", F.round(p, 6).alias("probability"), (draw(F.col("doc_id")) < p).alias("kept"))


def sample_mix(documents: DataFrame, targets: dict[str, DataFrame] | None = None, budget: float | str | None = None, rounds: int = ROUNDS, topics: dict[str, tuple[str, ...]] | None = None, tokens: str | None = None) -> DataFrame:
    """The documents that `mix` keeps, with their own columns only.

    The probability of a document depends on its cell alone, so the cells' probabilities are joined
    (their number is bounded by the levels of the margins) and no row is matched by id.
    """
    cells = _cell_chances(_described(documents, topics, tokens), targets, budget, rounds)
    named = {m: f"_{m}_of_cell" for m in MARGINS}
    small = cells.select(*(F.col(m).alias(named[m]) for m in MARGINS), F.col("probability").alias("_probability"))
    levels = _levels(documents, topics)
    on = [levels[m] == small[named[m]] for m in MARGINS]
    joined = documents.join(small, on, "inner").where(draw(documents["doc_id"]) < small["_probability"])
    return joined.select(*(documents[f"`{c}`"] for c in documents.columns))


def _topic_sql() -> str:
    counts = {name: " + ".join(f"(strlen(t) - strlen(replace(t, {_quoted(x)}, ''))) / {len(x.encode())}" for x in terms) for name, terms in TOPICS.items()}
    most = f"greatest({', '.join(counts.values())})"
    return f"CASE WHEN {most} = 0 THEN '{NO_TOPIC}' " + " ".join(f"WHEN {n} = {most} THEN '{name}'" for name, n in counts.items()) + " END"


def _quoted(term: str) -> str:
    return "chr(9)" if term == "\t" else f"'{term}'"


ORACLE = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(source, '') AS source, coalesce(lang, '') AS lang,
    {_topic_sql()} AS topic,
    len(list_filter(string_split_regex(t, '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> ''))::BIGINT AS n_tokens
  FROM (SELECT *, coalesce(text, '') AS t FROM documents)),
c AS (SELECT source, lang, topic, sum(n_tokens)::DOUBLE AS n FROM d GROUP BY ALL HAVING sum(n_tokens) > 0),
ts AS (SELECT source, p / sum(p) OVER () AS t_source FROM (SELECT source, pow(sum(n), {TEMPER["source"]}) AS p FROM c GROUP BY ALL)),
tl AS (SELECT lang, p / sum(p) OVER () AS t_lang FROM (SELECT lang, pow(sum(n), {TEMPER["lang"]}) AS p FROM c GROUP BY ALL)),
tt AS (SELECT topic, p / sum(p) OVER () AS t_topic FROM (SELECT topic, pow(sum(n), {TEMPER["topic"]}) AS p FROM c GROUP BY ALL)),
ipf AS (
  SELECT 0 AS k, source, lang, topic, n, t_source, t_lang, t_topic, n / sum(n) OVER () AS w
  FROM c JOIN ts USING (source) JOIN tl USING (lang) JOIN tt USING (topic)
  UNION ALL
  SELECT k + 1, source, lang, topic, n, t_source, t_lang, t_topic, w2 * t_topic / sum(w2) OVER (PARTITION BY topic)
  FROM (SELECT *, w1 * t_lang / sum(w1) OVER (PARTITION BY lang) AS w2
        FROM (SELECT *, w * t_source / sum(w) OVER (PARTITION BY source) AS w1 FROM ipf WHERE k < {ROUNDS}))),
f AS (SELECT *, w / n AS factor, max(w / n) OVER () AS f_max FROM ipf WHERE k = {ROUNDS}),
tried AS (
  SELECT *, ({KEPT_SHARE} * sum(n) OVER () - coalesce(sum(n) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM f WINDOW o AS (ORDER BY factor DESC, source, lang, topic)),
p AS (
  SELECT source, lang, topic, CASE WHEN factor > 0 THEN greatest(factor / f_max, least(1.0, coalesce(level * factor, 1.0))) ELSE 0 END AS p
  FROM (SELECT * REPLACE (max(CASE WHEN level * factor <= 1 THEN level END) OVER () AS level) FROM tried))
SELECT doc_id, source, lang, topic, n_tokens, round(coalesce(p, 0), 6) AS probability,
  CAST('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8) AS UBIGINT)::DOUBLE / 4294967296.0 < coalesce(p, 0) AS kept
FROM d LEFT JOIN p USING (source, lang, topic)
"""
