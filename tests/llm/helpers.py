"""Documents with the awkward cases, and brute-force versions of what SQL cannot express."""

from __future__ import annotations

import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOC = "doc_id long, text string, lang string, source string, TEXT2 string, n_chars long"

LONG = "word other thing " * 20_000
AWKWARD = [
    (1, None, None, None, "x", None),
    (2, "", "en", "a", None, 0),
    (3, " \t\n ", "en", "a", None, 4),
    (4, "one", "xx", None, None, 3),
    (5, LONG, "en", "b", None, len(LONG)),
    (6, "the same text here", "en", "a", None, 18),
    (7, "the same text here", "en", "a", None, 18),
    (6, "the same text here", "en", "a", None, 18),
    (None, "no id at all, but text", None, "c", None, 22),
    (8, "é ß 日本語 😀 <s> ▁ \x00 end", "fr", "c", None, 20),
]


def words(text):
    return WORD.findall(text or "")


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def groups(nodes, linked):
    """Smallest node that links reach, for each node."""
    root = {n: n for n in nodes}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                x, y = top(a), top(b)
                root[max(x, y)] = min(x, y)
    return {n: top(n) for n in nodes}
