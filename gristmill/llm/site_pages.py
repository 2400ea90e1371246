"""Main text of web pages by removal of site templates.

Every element subtree of a page is hashed, Spark counts per host on how many pages, and inside how many
different parents, each hash stands, and subtrees that recur across many pages of their host are deleted. What a
single page already says about itself (element names, classes and roles of menus, adverts and the like) is deleted
first: menus that differ from page to page recur nowhere, and small hosts have nothing to compare.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import discard, release_memory, stored
from .markup import Element, empty, main_text, parse, prune, subtree_hashes

#: A subtree is part of the template if it stands on this share of the host's pages ...
SHARE = 0.5
#: ... and in this many different surroundings.
SURROUNDINGS = 10
#: Elements that hold a page or its article are never template.
_KEPT = frozenset(("", "html", "body", "main", "article"))


def host(url: Column | str) -> Column:
    """Host of an address in lower case; null if there is none."""
    return F.lower(F.try_parse_url(F.col(url) if isinstance(url, str) else url, F.lit("HOST")))


def _subtrees(page: pa.Array) -> pa.Array:
    """Distinct (hash, hash of the parent) of the elements of each page that could be template."""
    out = []
    for text in page:
        root = parse((text.as_py() or b"").decode("utf-8", "replace"))
        prune(root)
        found = subtree_hashes(root)
        pairs = {(h, found[e.parent]) for e, h in found.items() if e.name not in _KEPT and not e.main_role}
        out.append([{"subtree": h, "parent": p} for h, p in sorted(pairs)])
    made = pa.array(out, pa.list_(pa.struct([("subtree", pa.int64()), ("parent", pa.int64())])))
    release_memory()
    return made


def _without(root: Element, template: set[int]) -> None:
    """Empty the subtrees of these hashes; hashes are those of the whole page, before anything is taken out."""
    found = subtree_hashes(root)
    empty(root, lambda e: found.get(e) in template and e.name not in _KEPT and not e.main_role)


def _extracted(page: pa.Array, template: pa.Array) -> pa.Array:
    out = []
    for text, hashes in zip(page, template, strict=True):
        root = parse((text.as_py() or b"").decode("utf-8", "replace"))
        prune(root)
        if known := hashes.as_py():
            _without(root, set(known))
        out.append(main_text(root))
    made = pa.array(out, pa.string())
    release_memory()
    return made


def site_templates(pages: DataFrame, share: float = SHARE, surroundings: int = SURROUNDINGS) -> DataFrame:
    """(host, template): hashes of the subtrees that recur on `share` or more of the host's pages, in `surroundings` or more different parents.

    An article that is published again and again recurs as a whole: its parts have one parent, so they stay. Each of a
    host's template subtrees stands on `share` of its pages, so there are at most 1/share times as many as a page has elements.
    Counting is by (host, subtree, parent) first, which no hot host gathers in one task.
    """
    rows = pages.select(host("url").alias("host"), F.arrow_udf(_subtrees, "array<struct<subtree:long, parent:long>>")(F.col("html").cast("binary")).alias("found")).where("host IS NOT NULL")
    # Read twice: for the hosts' pages and for the subtrees. Only hashes are written, no texts.
    rows = stored(rows, "subtrees")
    many = rows.groupBy("host").agg(F.count("*").alias("pages"))
    each = rows.select("host", F.explode("found").alias("f")).groupBy("host", "f.subtree", "f.parent").agg(F.count("*").alias("n"))
    recurring = each.groupBy("host", "subtree").agg(F.sum("n").alias("n"), F.count("*").alias("parents")).where(F.col("parents") >= surroundings)
    kept = recurring.join(many, "host").where(F.col("n") >= share * F.col("pages"))
    out = stored(kept.groupBy("host").agg(F.collect_set("subtree").alias("template")), "templates")
    discard(rows)
    return out


def extract_pages(pages: DataFrame, share: float = SHARE, surroundings: int = SURROUNDINGS) -> DataFrame:
    """(page_id, url, text, n_chars): the main text of every row of (page_id, url, html).

    The text is the article (else the main element, else the page) without menus, headers, footers, sidebars, notices,
    adverts, forms, scripts, styles, markup and readers' comments, and without the subtrees that `site_templates` finds on
    the page's host. Character references are decoded, white space inside a block is one space, blocks are trimmed and joined
    by an empty line. A null or empty page, or one without text, gives the empty text; a page without url or host has no
    site to compare with; rows that repeat a page_id or a url are pages of their own; bytes that aren't UTF-8 become
    U+FFFD. Other columns are ignored; no rows in, no rows out.
    """
    rows = pages.select("page_id", "url", "html")
    templates = site_templates(rows, share, surroundings)
    extract = F.arrow_udf(_extracted, "string")
    joined = rows.withColumn("host", host("url")).join(templates, "host", "left")
    out = joined.select("page_id", "url", extract(F.col("html").cast("binary"), F.col("template")).alias("text"))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
