from __future__ import annotations

import hashlib
import zlib

import duckdb
import pytest

from hourloom.llm import merkle
from hourloom.llm.oracles import ORACLES
from tests.llm.helpers import AWKWARD, DOC, lower

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, tampered=False):
    def part(value):
        return "-" if value is None else f"{len(str(value).encode())}:{value}"

    text = row["text"]
    if tampered and text is not None and row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0:
        text = lower(text)
    return digest("".join(part(row[f] if f != "text" else text) for f in FIELDS))


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        own = levels[-1]
        levels.append([digest("".join(own[k : k + 8])) for k in range(0, len(own), 8)])
    return levels


def expected(rows):
    langs = {}
    for row in rows:
        langs.setdefault(row["lang"], []).append(row)
    order = sorted(langs, key=lambda lang: (lang is not None, (lang or "").encode()))
    for lang in order:
        langs[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
    trees = {lang: levels_of([leaf(r) for r in langs[lang]]) for lang in order}
    top = levels_of([trees[lang][-1][0] for lang in order])
    out = []
    for g, lang in enumerate(order):
        for k, row in enumerate(langs[lang]):
            folded, siblings = leaf(row, tampered=True), ""
            for levels, at in ((trees[lang], k), (top, g)):
                for nodes in levels[:-1]:
                    run, place = nodes[at // 8 * 8 : at // 8 * 8 + 8], at % 8
                    siblings += "".join(run[:place] + run[place + 1 :])
                    folded = digest("".join(run[:place]) + folded + "".join(run[place + 1 :]))
                    at //= 8
            out.append((row["doc_id"], leaf(row), trees[lang][-1][0], top[-1][0], digest(siblings), folded, folded == top[-1][0]))
    return out


def compared(spark, rows):
    names = [c.split()[0] for c in DOC.split(", ")]
    got = [tuple(r) for r in merkle.verify(spark.createDataFrame(rows, DOC)).collect()]
    want = expected([dict(zip(names, row)) for row in rows])
    key = lambda row: tuple((v is None, v) for v in row)
    assert sorted(got, key=key) == sorted(want, key=key)
    return got


def test_awkward_rows(spark):
    """Nulls in every column, empty and very long texts, repeated rows and ids, a lone leaf, and a column named almost like text."""
    got = compared(spark, AWKWARD)
    assert len(got) == len(AWKWARD)
    clash = merkle.verify(spark.createDataFrame(AWKWARD, DOC.replace("TEXT2", "TEXT")))  # the exact name wins
    assert sorted(r.leaf for r in clash.collect()) == sorted(g[1] for g in got)


@pytest.mark.parametrize("sizes", [(1,), (8,), (9,), (65, 1, 8), (513, 64, 7, 2, 1, 1, 1, 1, 1, 1)])
def test_trees_of_any_shape(spark, sizes):
    """Last runs of one node, more than eight langs, hot langs; ids repeat across langs."""
    rows = [
        (k * 3 if n % 2 else k, f"Text {n} {k}" * (k % 4), None if n == 0 else f"l{n:02d}é", None if k % 5 else "S", "x", k)
        for n, size in enumerate(sizes) for k in range(size)
    ]
    got = compared(spark, rows)
    tampered = [r for r in got if not r[-1]]
    assert len(tampered) < len(got)


def test_only_what_was_tampered_fails(spark):
    rows = [(k, "Upper" if k % 2 else "lower", "en", "a", "x", 5) for k in range(200)]
    bad = {r[0] for r in compared(spark, rows) if not r[-1]}
    assert bad == {k for k in range(200) if zlib.crc32(str(k).encode()) % 3 == 0 and k % 2}


def test_empty_table_and_restored_setting(spark):
    before = spark.conf.get("spark.sql.cteRecursionRowLimit", None)
    empty = merkle.verify(spark.createDataFrame([], DOC))
    assert empty.count() == 0
    assert empty.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert spark.conf.get("spark.sql.cteRecursionRowLimit", None) == before


def test_the_manifest_has_the_levels_and_its_sql_agrees(spark, tmp_path):
    rows = [(k, f"T{k}", ("en", "de", None)[k % 3], "a", "x", k) for k in range(300)]
    docs = spark.createDataFrame(rows, DOC)
    manifest = merkle.build(docs, folder=str(tmp_path / "m"))
    assert {r.level: r["count"] for r in manifest.runs.where("tree = 0").groupBy("level").count().collect()} == {1: 13, 2: 2, 3: 1}
    assert manifest.runs.where(f"tree = {merkle.TOP}").count() == 1 and manifest.subroots.count() == 3
    assert (tmp_path / "m" / "trees" / "level=3").exists()
    documents = docs.drop("TEXT2").toPandas()  # noqa: F841  read by name below
    want = duckdb.sql(ORACLES["op12_merkle"]).fetchall()
    assert sorted(want) == sorted(tuple(r) for r in merkle.verify(docs).collect())
