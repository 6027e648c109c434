from __future__ import annotations

import random

import pytest
import public_tokenizers
import sentencepiece
from pyspark.sql import functions as F

import __spark_entry__ as driver
import corpus_pipeline
from check import rows_of
from hourloom.llm import queries, simhash
from tests.llm.helpers import AWKWARD, DOC, groups, words
from tests.llm.test_rules_lines import dedup

SF_DIR = "/root/testdata/sf0.001"


def test_every_query_is_registered():
    names = driver.queries()
    assert {f"op{n}" for n in range(1, 14)} == {k.split("_")[0] for k in queries.QUERIES}
    assert set(queries.QUERIES) | {"pipeline"} <= set(names)
    assert set(queries.ORACLES) <= set(driver.oracle_sql())


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_matches_its_sql(spark, name):
    import duckdb

    duck = duckdb.connect()
    duck.execute(f"create view documents as select * from '{SF_DIR}/documents.parquet'")
    df = queries.QUERIES[name](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
    result = duck.execute(queries.ORACLES[name])
    columns = [c[0] for c in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows_of(df.columns, [tuple(r) for r in df.collect()]) == rows_of(columns, result.fetchall())


@pytest.mark.parametrize("name", ["op1_url_filter", "op4_toxicity", "op6_language_id", "op7_sentencepiece", "op8_embedding_caps", "op9_simhash", "op10_token_counts"])
def test_query_returns_every_row(spark, name):
    table = {"op1_url_filter": "pages", "op8_embedding_caps": "embeddings"}.get(name, "documents")
    key = {"pages": "page_id", "embeddings": "vec_id"}.get(table, "doc_id")
    want = sorted(r[0] for r in spark.read.parquet(f"{SF_DIR}/{table}.parquet").select(key).collect())
    assert sorted(r[0] for r in queries.QUERIES[name](spark, SF_DIR).select(key).collect()) == want


def test_stages_on_the_smallest_tables(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, seen = docs.columns, []
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF_DIR).write.parquet(str(tmp_path / str(k)))
        out = spark.read.parquet(str(tmp_path / str(k)))
        seen.append((docs.collect(), out.collect()))
        if k < 4:
            assert out.columns == columns
        docs = out
    (before, kept), (_, deduped), (_, single), (_, mixed), (_, tokens) = seen
    verdicts = {r.doc_id: r.kept for r in queries.QUERIES["op2_quality_rules"](spark, SF_DIR).collect()}
    assert {r.doc_id for r in kept} == {d for d, k in verdicts.items() if k} and len(kept) < len(before)
    want = {int(d): text for d, _, _, text in dedup([(r.doc_id, r.text) for r in kept])}
    assert {r.doc_id: r.text for r in deduped} == want
    assert all(r.n_chars == len(r.text) for r in deduped if r.text != {x.doc_id: x.text for x in kept}[r.doc_id])

    def shingles(text):
        w = words(text.lower())
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    sets = {r.doc_id: shingles(r.text) for r in deduped}
    stay = {r.doc_id for r in single}
    alike = [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    assert sum(a in stay and b in stay for a, b in alike) <= 0.1 * len(alike)
    best = {d: max(len(sets[d] & s) / len(sets[d] | s) for e, s in sets.items() if e != d) for d in sets if d not in stay}
    assert all(v > 0.5 for v in best.values()) and best
    assert sorted(map(repr, mixed)) == sorted(map(repr, single))
    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert {r.doc_id: r.ids for r in tokens} == {r.doc_id: library.encode(r.text) for r in mixed}


def test_stages_on_awkward_rows_and_empty_tables(spark):
    for rows in (AWKWARD, []):
        docs = spark.createDataFrame(rows, DOC)
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, docs, SF_DIR)
            assert out.count() <= len(rows)
            if name != "SentencePiece":
                assert out.columns == docs.columns
    docs = spark.createDataFrame(AWKWARD, DOC)
    assert {r.doc_id for r in corpus_pipeline.quality_rules(spark, docs, SF_DIR).collect()} <= {5}
    dedup_out = corpus_pipeline.line_dedup(spark, docs, SF_DIR).where(F.col("doc_id") == 1).first()
    assert dedup_out.text is None and dedup_out.n_chars is None
    kept = sorted(str(r.doc_id) for r in corpus_pipeline.near_dedup(spark, docs, SF_DIR).collect())
    assert kept == sorted(["1", "4", "5", "6", "6", "8", "None"])


def test_near_dedup_decides_by_the_sets(spark, monkeypatch):
    monkeypatch.setattr(simhash, "SET_ROWS", 50)
    monkeypatch.setattr(simhash, "BLOCK_ROWS", 16)
    rng = random.Random(11)
    texts = []
    for n in (8, 9, 12, 30, 60, 150, 400):
        for family in range(12):
            base = [f"n{n}f{family}w{k}" for k in range(n)]
            for copy in range(6):
                some = list(base)
                for _ in range(copy and rng.randint(0, max(1, n // 25))):
                    some[rng.randrange(n)] = f"x{rng.randint(0, 10**9)}"
                texts.append(" ".join(some[: n - rng.randint(0, 2)]))
    for k in range(150):  # one large family of near copies
        some = [f"big{w}" for w in range(120)]
        for _ in range(1 + k % 4):
            some[rng.randrange(120)] = f"y{rng.randint(0, 10**9)}"
        texts.append(" ".join(some))

    def shingles(text):
        w = text.split()
        return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}

    sets = dict(enumerate(map(shingles, texts)))
    linked = lambda a, b: len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8
    want = groups(list(sets), linked)
    rows = [(k, t, "en", "a", None, len(t)) for k, t in enumerate(texts)]
    out = corpus_pipeline.near_dedup(spark, spark.createDataFrame(rows, DOC), SF_DIR).collect()
    assert {r.doc_id for r in out} == {k for k, top in want.items() if k == top}
    assert 100 < len(out) < len(texts) - 100
