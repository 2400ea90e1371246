"""Fill-in-middle transformation by repeated-capture matching.

One fullmatch of `(unit)*` with the regex library, which keeps every repetition of a group, cuts a text
into units: the ends of the captures give their number and both cut offsets, without a loop over units.
"""

from __future__ import annotations

from functools import lru_cache

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import release_memory

#: One code point, line breaks included.
CODE_POINT = r"(?s:.)"
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Percent of the documents that stay plain, and percent of the others whose suffix comes first.
PLAIN, SUFFIX_FIRST = 10, 20

FORMS = "struct<n:long, form:string, prefix_chars:long, middle_chars:long, output:binary>"
_FORMS = pa.struct([("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.binary())])


@lru_cache(maxsize=8)
def _repeated(unit: str) -> regex.Pattern:
    """The pattern whose group 1 holds every unit; possessive, so nothing is kept for going back."""
    return regex.compile(f"({unit})*+")


def cut(text: str, unit: str, first: int, second: int) -> tuple[int, int, int]:
    """(number of units n, end of the prefix, end of the middle): the lesser and the greater of both numbers mod n + 1, as offsets."""
    whole = _repeated(unit).fullmatch(text)
    if whole is None:
        raise ValueError("a text isn't a sequence of units: the unit must match every text from any place on")
    ends = whole.ends(1)
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def arrange(text: str, unit: str, h: tuple[int, int, int, int], plain: int, suffix_first: int) -> tuple[int, str, int | None, int | None, str]:
    n, a, b = cut(text, unit, h[0], h[1])
    if not text or h[2] % 100 >= 100 - plain or any(mark in text for mark in (PREFIX, SUFFIX, MIDDLE)):
        return n, "plain", None, None, text
    prefix, middle, suffix = text[:a], text[a:b], text[b:]
    if h[3] % 100 < suffix_first:
        return n, "spm", a, b - a, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    return n, "psm", a, b - a, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"


def hashed_numbers(key: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of the hex sha256 of `seed:key`, as unsigned numbers; a null key is the empty text."""
    digits = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digits, 8 * k + 1, 8), 16, 10).cast("long") for k in range(4)]


def fill_in_middle(documents: DataFrame, seed: int = 1, unit: str = CODE_POINT, plain: int = PLAIN, suffix_first: int = SUFFIX_FIRST) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every row of (doc_id, text).

    n: units of the text. form: `plain` (output: the text), `psm` or `spm`; plain are `plain` percent of the documents by the
    hash of the id, empty texts and texts that hold a sentinel, and then both lengths (code points) are null. A null
    text is empty; a null doc_id hashes as the empty text; rows that repeat an id are cut by the same numbers, each
    in its own text. `unit` is a pattern that must match any text over and over (`\\S+\\s*|\\s+`: words). Bytes
    that aren't UTF-8 are units of their own and come back unchanged. Other columns are ignored; no rows in, no rows out.
    """

    @F.arrow_udf(FORMS)
    def made(text: pa.Array, h1: pa.Array, h2: pa.Array, h3: pa.Array, h4: pa.Array) -> pa.Array:
        out = []
        for t, *h in zip(text, *(x.to_pylist() for x in (h1, h2, h3, h4)), strict=True):
            n, form, prefix, middle, output = arrange((t.as_py() or b"").decode("utf-8", "surrogateescape"), unit, h, plain, suffix_first)
            out.append({"n": n, "form": form, "prefix_chars": prefix, "middle_chars": middle, "output": output.encode("utf-8", "surrogateescape")})
        done = pa.array(out, _FORMS)
        release_memory()
        return done

    rows = documents.select("doc_id", made(F.col("text").cast("binary"), *hashed_numbers(F.col("doc_id"), seed)).alias("made"))
    return rows.select("doc_id", "made.n", "made.form", "made.prefix_chars", "made.middle_chars", F.col("made.output").cast("string").alias("output"))


def restored(output: Column | str, form: Column | str) -> Column:
    """The text that an output of `fill_in_middle` was made from. Null in, null out.

    A text with a sentinel in it stays plain, so each sentinel stands once in the other forms.
    """
    output, form = (F.col(c) if isinstance(c, str) else c for c in (output, form))
    parts = F.split(F.substr(output, F.lit(len(PREFIX) + 1)), f"{PREFIX}|{SUFFIX}|{MIDDLE}")
    first, second, middle = (F.get(parts, F.lit(k)) for k in range(3))
    return F.when(form == "psm", F.concat(first, middle, second)).when(form == "spm", F.concat(second, middle, first)).otherwise(output)


#: DuckDB SQL of the registered query: code points, seed 1.
ORACLE = """
WITH hashed AS (
    SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n, sha256(concat('1:', doc_id)) AS h FROM documents
), numbers AS (
    SELECT doc_id, text, n, CAST('0x' || substr(h, 1, 8) AS UBIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS UBIGINT) % (n + 1) AS c2,
           CAST('0x' || substr(h, 17, 8) AS UBIGINT) % 100 AS c3, CAST('0x' || substr(h, 25, 8) AS UBIGINT) % 100 AS c4 FROM hashed
), cuts AS (
    SELECT doc_id, text, n, CAST(least(c1, c2) AS BIGINT) AS a, CAST(greatest(c1, c2) AS BIGINT) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c3 >= 90 THEN 'plain' WHEN c4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM numbers
), parts AS (
    SELECT doc_id, text, n, form, a, b, substr(text, 1, a) AS p, substr(text, a + 1, b - a) AS m, substr(text, b + 1) AS s FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
