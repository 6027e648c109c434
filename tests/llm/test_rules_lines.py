from __future__ import annotations

import hashlib
import random
from collections import Counter

from hourloom.llm import lines, rules
from tests.llm.helpers import AWKWARD, DOC, lower, words


def base(text):
    text = text or ""
    w = words(text)
    spots = Counter(tuple(w[k : k + 3]) for k in range(len(w) - 2))
    covered = {k + d for k in range(len(w) - 2) if spots[tuple(w[k : k + 3])] > 1 for d in range(3)}
    kept = [x for x in text.split("\n") if words(x)]
    return (
        len(w),
        sum(map(len, w)),
        sum(c in "#*$%&|<>" for c in text),
        len(kept) - len(set(kept)),
        len(covered),
        len(w) < 50 or 100 * len(covered) > 50 * len(w),
    )


TEXTS = [
    "a a a a",
    "a b c a b c",
    "x y z w x y",
    "l1 #*\nl1 #*\n\n \n \nl2\nl1 #*",
    " ".join(f"w{k % 30}" for k in range(60)),
    " ".join(f"w{k}" for k in range(49)),
    " ".join(f"w{k}" for k in range(50)),
]


def test_base_counts_match_a_plain_count(spark):
    rows = AWKWARD + [(20 + k, t, "en", "a", None, 0) for k, t in enumerate(TEXTS)]
    got = rules.judge(spark.createDataFrame(rows, DOC)).collect()
    fields = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r.doc_id), *[r[f] for f in fields]) for r in got) == sorted((str(r[0]), *base(r[1])) for r in rows)


def test_odd_histograms_go_and_clean_ones_stay(spark):
    rng = random.Random(1)
    clean = [" ".join(rng.choice(["the", "of", "and", "to", "in", f"w{k}", f"v{k}"]) for k in range(200)) for _ in range(12)]
    odd = " ".join(f"$$$### w{k}&&&" for k in range(120))
    none = " ".join(f"word{k} thing{k}" for k in range(120))
    rows = [(k, t, "en", "a", None, 0) for k, t in enumerate([*clean, odd, none])]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, DOC), max_word_distance=0.5).collect()}
    assert all(got[k].kept for k in range(12))
    assert not got[12].base_failed and not got[12].kept and got[12].class_distance > got[0].class_distance
    assert not got[13].kept and got[13].word_distance > 0.5


def test_short_or_unknown_documents_are_not_compared(spark):
    rows = [(1, "$$$ " * 30 + " ".join(f"w{k}" for k in range(25)), "en", "a", None, 0), (2, "$ " * 300, None, "a", None, 0)]
    got = {r.doc_id: r for r in rules.judge(spark.createDataFrame(rows, DOC)).collect()}
    assert got[1].word_distance is None and got[2].class_distance is None and got[2].word_distance is None


def test_rules_on_an_empty_table(spark):
    assert rules.judge(spark.createDataFrame([], DOC)).count() == 0


def dedup(rows, least=2):
    key = lambda s: lower(s.strip(" \t\n\x0b\x0c\r"))
    where = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            for line in (text or "").split("\n"):
                where.setdefault(key(line), set()).add(doc_id)
    out = []
    for doc_id, text, *_ in rows:
        every = (text or "").split("\n")
        kept = [
            x
            for x in every
            if doc_id is None or len(key(x)) < 10 or len(where[key(x)]) < least or min(where[key(x)]) == doc_id
        ]
        out.append((str(doc_id), len(every), len(every) - len(kept), "\n".join(kept)))
    return sorted(out)


LINES = [
    (1, "A Shared Line Of Text\nown line number one\nshort", "en", "a", None, 0),
    (2, " a shared line of text\t\nshort\nown line number two\nA SHARED LINE OF TEXT", "en", "a", None, 0),
    (3, "A shared line of text", "en", "a", None, 0),
    (4, "ÉCOLE ÉCOLE É\nécole école é", "fr", "a", None, 0),
    (5, "ÉCOLE École É", "fr", "a", None, 0),
    (5, "another text of five\nA shared line of text", "fr", "a", None, 0),
    (None, "A shared line of text", "en", "a", None, 0),
]


def test_line_dedup_matches_a_plain_version(spark):
    for rows in (LINES, AWKWARD, LINES + AWKWARD):
        got = lines.drop_shared_lines(spark.createDataFrame(rows, DOC)).collect()
        assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == dedup(rows)


def test_line_dedup_with_a_higher_threshold(spark):
    got = lines.drop_shared_lines(spark.createDataFrame(LINES, DOC), min_documents=4).collect()
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in got) == dedup(LINES, 4)


def test_line_dedup_on_an_empty_table(spark):
    assert lines.drop_shared_lines(spark.createDataFrame([], DOC)).count() == 0


def test_kept_hash_is_of_utf8(spark):
    row = lines.drop_shared_lines(spark.createDataFrame(AWKWARD[-1:], DOC)).selectExpr("sha2(kept, 256) as h").first()
    assert row.h == hashlib.sha256(AWKWARD[-1][1].encode()).hexdigest()
