"""Plain Python versions of the contracts, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")
ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "one",
    "a b c d",
    "A b C d e",
    "don't 'tis  it's ''ll",
    "tab\tand  two  blanks ",
    "<|endoftext|> x<|endoftext|>y",
    "é È ñ ß 漢字 😀   x",
    "same line\nsame line\nsame line\n\nother",
    "x " * 3000,
    "word " + "z" * 5000,
    "\x1c \x00 a|b # $",
    "The end.\nThe end.",
]
#: Two words that a polynomial hash modulo a power of two can't tell apart: parities of the ones in 0..2047, and their complement.
THUE_MORSE = "".join("ab"[k.bit_count() % 2] for k in range(2048))
ODD_TEXTS += [THUE_MORSE, THUE_MORSE.translate({97: "b", 98: "a"}), THUE_MORSE + "\n" + THUE_MORSE.translate({97: "b", 98: "a"})]


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_vectors(rows):
    """rows: (vec_id, embedding, label) -> vec_id: (n_links, component_id, kept)."""
    ok = []
    for i, v, label in rows:
        if v is None or label is None or any(x is None for x in v) or not len(v):
            continue
        a = np.array(v, float)
        if np.isfinite(a).all() and (a != 0).any():
            ok.append((i, a / np.sqrt((a * a).sum()), label))
    links = [(a[0], b[0]) for k, a in enumerate(ok) for b in ok[:k] if a[2] == b[2] and len(a[1]) == len(b[1]) and float(a[1] @ b[1]) >= 0.93]
    n = Counter(x for pair in links for x in pair)
    top = components([r[0] for r in rows], links)
    return {i: (n[i], top[i], top[i] == i) for i, _, _ in rows}


def repeated_bytes(rows, width=50):
    """rows: (doc_id, text) -> doc_id: (n_bytes, n_removed, n_spans, sha)."""
    first = {}
    for i, text in sorted(rows, key=lambda r: r[0]):
        raw = (text or "").encode()
        for k in range(len(raw) - width + 1):
            first.setdefault(raw[k : k + width], i)
    out = {}
    for i, text in rows:
        raw = (text or "").encode()
        gone = np.zeros(len(raw), bool)
        for k in range(len(raw) - width + 1):
            if first[raw[k : k + width]] < i:
                gone[k : k + width] = True
        spans = int(gone[:1].sum() + (gone[1:] & ~gone[:-1]).sum())
        kept = bytes(np.frombuffer(raw, np.uint8)[~gone])
        out[i] = (len(raw), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest())
    return out


def shingles(text, n):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)} or {tuple(words)}


def near_texts(rows, n=4, percent=85):
    """rows: (doc_id, text) -> doc_id: (n_shingles, component_id)."""
    sets = [(i, shingles(t, n)) for i, t in rows]
    links = []
    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                both = len(a & b)
                if 100 * both >= percent * (len(a) + len(b) - both):
                    links.append((i, j))
    top = components([i for i, _ in rows], links)
    return {i: (len(s), top[i]) for i, s in sets}


def rule_digest(text):
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    count = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if count[w] >= 2 for j in range(8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(covered), failed


def rules_keep(text):
    """The verdict of the quality rules, from the words of a text."""
    text = text or ""
    n, chars, symbols, dup, _, failed = rule_digest(text)
    words = WORD.findall(text)
    lines = sum(bool(WORD.search(x)) for x in text.split("\n"))
    letters = sum(c.isascii() and c.isalpha() or ord(c) > 127 for c in text)
    return not (
        failed
        or symbols > 0.03 * max(chars, 1)
        or sum("A" <= c <= "Z" for c in text) > 0.3 * max(len(text), 1)
        or dup > 0.5 * max(lines, 1)
        or sum(a == b for a, b in zip(words, words[1:], strict=False)) > 0.3 * max(n, 1)
        or letters < 0.45 * max(chars, 1)
        or chars > 30 * max(n, 1)
    )


def chat_chars(rows):
    """rows: (conv_id, turn, role, text) -> conv_id: code points of all its examples."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn, role or "", text or ""))
    size = lambda t: len(t) + sum(t.count(c) for c in "\\<[")
    out = {}
    for c, turns in by.items():
        so_far, total = 0, 0
        for _, role, text in sorted(turns):
            so_far += len("<|start|><|sep|><|end|>") + size(role) + size(text)
            total += so_far if role == "assistant" else 0
        out[c] = total + (so_far if role != "assistant" else 0)
    return out


def chat_digest(rows):
    """rows: (conv_id, turn, role, text) -> conv_id: (n_turns, turns sha, loss chars, loss sha)."""
    by = defaultdict(list)
    for c, turn, role, text in rows:
        by[c].append((turn, role or "", text or ""))
    out = {}
    for c, turns in by.items():
        turns.sort()
        said = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        out[c] = (len(turns), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def crc_of_ids(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())
