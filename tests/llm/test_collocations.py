from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from hourloom.llm import collocations as c
from tests.llm.helpers import AWKWARD, DOC, lower


def phrases_of(rows, least=30, covered=80):
    counts = {}
    for text, lang in rows:
        own = counts.setdefault("und" if lang is None else lang, Counter())
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", lower(text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            for k in range(1, 5):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        n = sum(a for p, a in f.items() if len(p) == 1)
        found = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        inner = {
            p[i : i + k]
            for p, a in found.items() for k in range(2, len(p)) for i in range(len(p) - k + 1)
            if 100 * a >= covered * f[p[i : i + k]]
        }
        for p, a in found.items():
            if p not in inner:
                score, _, left, right = min((2_000_000 * a // (f[p[:k]] + f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
                out.append((lang, " ".join(p), a, left, right, n, score))
    return out


def ranked(rows, top):
    out = []
    for lang in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == lang), key=lambda r: (-r[6], -r[2], r[1].encode()))
        out += [(lang, k + 1, *r[1:]) for k, r in enumerate(own[:top])]
    return sorted(out)


def some_rows(seed, n):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(12)] + ["New", "york", "CITY", "Ünï", "日本"]
    rows = []
    for k in range(n):
        text = ""
        for _ in range(rng.randint(0, 12)):
            text += rng.choice(["new york city ", "New York ", "in the New\tYORK city hall ", "w1 w2 w3 w4 w5 "]) if rng.random() < 0.3 else ""
            text += rng.choice(words) + rng.choice([" ", "  ", "\t", ". ", ",", "\n", "\r", "\x0b", " ; ", "\xa0"])
        rows.append((text, ("en", "fr", None)[k % 3]))
    return rows


def mined(spark, rows, least):
    return c.mine(spark.createDataFrame(rows, "text string, lang string"), least)


@pytest.mark.parametrize("least, shard", [(30, 500_000), (5, 7), (2, 3)])
def test_against_brute_force(spark, monkeypatch, least, shard):
    """Also with vocabulary and candidates in many shards, few bits, and words looked at in small slices."""
    for name, value in (("VOCABULARY", shard), ("TRIE", 10 * shard), ("PAIR_BITS", 1 << 18 if shard > 100 else 1 << 16)):
        monkeypatch.setattr(c, name, value)
    if shard < 100:
        for name, value in (("SLICE", 11), ("ROWS", 5), ("BUFFER", 64), ("HELD_WORDS", 9), ("ROW_WORDS", 4), ("SALTS", 2)):
            monkeypatch.setattr(c, name, value)
    rows = some_rows(least, 400)
    phrases = mined(spark, rows, least)
    want = phrases_of(rows, least)
    assert sorted(tuple(r) for r in phrases.collect()) == sorted(want) and len(want) > 10
    assert sorted(tuple(r) for r in c.best(phrases, 6).collect()) == ranked(want, 6)


def test_awkward_texts_give_no_row_or_the_right_ones(spark):
    docs = spark.createDataFrame(AWKWARD, DOC).withColumnRenamed("TEXT2", "Lang")
    got = [tuple(r) for r in c.best(c.mine(docs)).collect()]
    want = ranked(phrases_of([(r[1], r[2]) for r in AWKWARD]), 2_000)
    assert sorted(got) == want and want  # the very long text repeats three words
    assert c.mine(spark.createDataFrame([], DOC)).count() == 0
    blank = spark.createDataFrame([(1, None, "en", "a", "x", 1), (2, " \t.\n", "en", "a", "x", 1)], DOC)
    assert c.best(c.mine(blank)).count() == 0


def test_repeated_rows_count_and_ties_go_by_bytes(spark):
    rows = [("a b. c d. é f", "en")] * 30
    got = sorted(tuple(r) for r in c.best(mined(spark, rows, 30)).collect())
    assert got == [("en", k + 1, p, 30, 30, 30, 180, 1_000_000) for k, p in enumerate(("a b", "c d", "é f"))]
    assert c.best(mined(spark, rows, 31)).count() == 0


def test_double_array_counts_like_a_dictionary():
    rng = np.random.default_rng(3)
    for _ in range(20):
        some = {tuple(rng.integers(1, 40, rng.integers(2, 5))) for _ in range(200)}
        phrases = np.array([list(p) + [0] * (4 - len(p)) for p in sorted(some)], np.int32)
        trie = c._unpacked(c._packed(__import__("pandas").DataFrame(phrases, columns=["w1", "w2", "w3", "w4"]).assign(no=range(len(phrases))))["trie"][0])
        words = rng.integers(-1, 60, 3_000).astype(np.int32)
        want = [
            sum(tuple(words[k : k + len(p)]) == p for k in range(2_900))
            for p in (tuple(x for x in row if x) for row in phrases.tolist())
        ]
        assert trie.count(words[: 2_900 + 3], 2_900).tolist() == want


def test_scores_beyond_64_bits(spark):
    big = 4 * 10**18
    rows = [([1, 2], big), ([1], big), ([2], big + 1)]
    got = c._scored(spark.createDataFrame(rows, "phrase array<int>, a long")).collect()
    assert [tuple(r) for r in got] == [([1, 2], big, big, big + 1, 2_000_000 * big // (2 * big + 1))]
