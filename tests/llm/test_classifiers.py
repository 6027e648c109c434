from __future__ import annotations

import random
import zlib
from itertools import product

import pytest

from hourloom.llm import langid, toxicity, urls
from hourloom.llm.queries import URL_RULES
from tests.llm.helpers import AWKWARD, DOC

PAGE = "page_id long, url string, html string, URL2 string"
URLS = [
    "http://A.Example.com/en/1", "https://www.example.com/en/x?q=/fr/", "http://example.com/en", "http://example.com#/en/",
    "http://notexample.com/en/", "ftp://x.net/es/", "http://x.net/es?", "http://net/fr/", "http://net", "://b.net/fr/a://c",
    "no scheme.net/es/", "", None, "http://", "http://free-bets.org/x", "http://cheappills.org/", "http://citynews.org/",
    "http://xn--e1a.org:80/", "http://" + "verylongname" * 20 + ".org/a/b",
]


def plain_rule(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
        host, path = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut]), rest[cut:]
        path = path[: min([path.index(c) for c in "?#" if c in path], default=len(path))]
    best = None
    for verdict, rule in URL_RULES:
        name, _, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith("/" + start) and (best is None or len(rule) > len(best[1])):
            best = verdict, rule
    return host, path, best


def test_rules_match_a_plain_version_and_bayes_decides_the_rest(spark):
    rows = [(k, u, None, None) for k, u in enumerate(URLS)] + [(None, URLS[0], None, None), (0, URLS[0], None, None)]
    got = urls.judge(spark.createDataFrame(rows, PAGE), URL_RULES).collect()
    assert len(got) == len(rows)
    for r in got:
        url = URLS[r.page_id or 0]
        host, path, best = plain_rule(url)
        assert (r.host, r.path, r.rule) == (host, path, best and best[1])
        if best:
            assert r.verdict == best[0]
    by_url = {URLS[r.page_id or 0]: r for r in got}
    assert by_url["http://cheappills.org/"].words == ["cheap", "pills"]
    assert by_url["http://cheappills.org/"].verdict == by_url["http://free-bets.org/x"].verdict == "block"
    assert by_url["http://citynews.org/"].words == ["city", "news"]
    assert by_url["http://citynews.org/"].verdict == by_url[None].verdict == "allow"
    assert urls.judge(spark.createDataFrame([], PAGE), URL_RULES).count() == 0


def test_segmentation_is_the_likeliest():
    rng = random.Random(4)
    for _ in range(200):
        counts = {"".join(rng.choices("ab", k=rng.randint(1, 3))): rng.randint(1, 50) for _ in range(5)}
        total, name = sum(counts.values()), "".join(rng.choices("ab", k=7))

        def chance(parts, counts=counts, total=total):
            out = 1.0
            for w in parts:
                out *= counts[w] / total if w in counts else 10 / (total * 10 ** len(w))
            return out

        ways = []
        for cuts in product([0, 1], repeat=6):
            parts = [name[0]]
            for c, letter in zip(cuts, name[1:], strict=True):
                if c:
                    parts.append(letter)
                else:
                    parts[-1] += letter
            ways.append(parts)
        found = urls.segment(name, counts, max(2, total))
        assert "".join(found) == name
        assert chance(found) == pytest.approx(max(map(chance, ways)), rel=1e-9)


def test_word_counts_come_from_the_texts(spark):
    texts = spark.createDataFrame([("<p>Red redHouse</p> red",), (None,), ("",)], "text string")
    assert {r.word: r.n for r in urls.word_counts(texts).collect()} == {"red": 2, "redhouse": 1}


def invented(letters, seed, n):
    rng = random.Random(seed)
    return [" ".join("".join(rng.choices(letters, k=rng.randint(2, 6))) for _ in range(60)) for _ in range(n)]


def test_languages_of_held_out_documents(spark):
    rows, k = [], 10
    for lang, letters in (("xa", "aeioustrn"), ("xb", "aeioumpkw"), ("xc", "абвгдежз")):
        for text in invented(letters, lang, 40):
            rows.append((k, text, lang, None, None, 0))
            k += 1
    got = {r.doc_id: r for r in langid.identify(spark.createDataFrame(rows, DOC)).collect()}
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 3 == 1]
    assert {r[0] for r in held} == {d for d, r in got.items() if r.held_out} and len(held) > 20
    assert sum(got[r[0]].lang_pred == r[2] for r in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_profiles_follow_the_definition():
    space = langid.Space(64, 3)
    keys, counts = space.grams("Ab, ab")
    want = sum(space.vector(tuple(map(ord, g))) for g in ("\0ab", "ab\0", "b\0a", "\0ab", "ab\0"))
    assert (space.bundle(keys, counts) == want).all()
    long = "abc dé " * 400_000
    assert langid.Space(8, 3).grams(long)[1].sum() >= len(long) - 10
    assert len(space.grams("123 .,")[0]) == 0


def test_languages_of_awkward_rows(spark):
    got = langid.identify(spark.createDataFrame(AWKWARD, DOC)).collect()
    assert len(got) == len(AWKWARD)
    assert {r.lang_pred for r in got if r.doc_id in (1, 2, 3)} == {"und"}
    assert all(r.score == 0 for r in got if r.lang_pred == "und")
    assert langid.identify(spark.createDataFrame([], DOC)).count() == 0


LABEL = "doc_id long, quality int, toxic int, Toxic2 int"


def test_toxic_words_are_learned(spark):
    rng, rows, labels = random.Random(2), [], []
    for k in range(900):
        some = ["".join(rng.choices("abdegilnorst", k=rng.randint(2, 6))) for _ in range(rng.randint(20, 60))]
        toxic = k % 6 == 0
        if toxic:
            for _ in range(4):
                some.insert(rng.randrange(len(some)), "zzq" + rng.choice(["ab", "cd", "ef", "gh"]))
        rows.append((k, " ".join(some), "en", None, None, 0))
        labels.append((k, 1, int(toxic), None))
    labels += [(5, 1, None, None), (None, 1, 1, None), (10_000, 1, 1, None)]
    docs, marks = spark.createDataFrame(rows, DOC), spark.createDataFrame(labels, LABEL)
    got = {r.doc_id: r for r in toxicity.score(docs, marks).collect()}
    held = [d for d, r in got.items() if r.held_out]
    assert set(held) == {k for k in range(900) if zlib.crc32(str(k).encode()) % 5 == 0}
    assert sum(got[d].predicted == (d % 6 == 0) for d in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in got.values())


def test_features_see_lexicon_disguise_and_second_person():
    names = dict(zip(toxicity.FEATURES, toxicity.features("You are an IDIOT!! st@pid id1ot sooo", toxicity.Weights({"=an": 2.0})), strict=True))
    assert names["distinct_hits"] == 1 and names["near_second"] == 1.0
    assert names["hidden_hits_rate"] > 0 and names["mixed_words"] > 0
    assert names["mark_runs"] > 0 and names["caps_words"] > 0 and names["stretched"] > 0 and names["largest_weight"] == 2.0
    assert toxicity.features(" \n", toxicity.Weights({})) == [0.0] * len(toxicity.FEATURES)


def test_toxicity_without_enough_labels(spark):
    docs = spark.createDataFrame(AWKWARD, DOC)
    for labels in ([], [(6, 1, 1, None), (7, 1, 0, None), (6, 1, 0, None)]):
        got = toxicity.score(docs, spark.createDataFrame(labels, LABEL)).collect()
        assert len(got) == len(AWKWARD) and len({r.score for r in got}) == 1
    assert toxicity.score(spark.createDataFrame([], DOC), spark.createDataFrame([], LABEL)).count() == 0
