from __future__ import annotations

import math

import numpy as np
import pytest

from hourloom.llm import graph as g

VEC = "vec_id long, embedding array<float>, label int, LABEL2 string"


def brute(rows, every, nearest):
    """(query_id, rank, vec_id, score) over usable rows, by row."""
    usable = [
        (v, np.asarray(e, np.float32).astype(float)) for v, e, *_ in rows
        if v is not None and e and all(x is not None and math.isfinite(x) for x in e) and any(e)
    ]
    out = []
    for k, (v, e) in enumerate(usable):
        if v % every == 0:
            near = [
                (-float(e @ f / (np.linalg.norm(e) * np.linalg.norm(f))), w)
                for j, (w, f) in enumerate(usable) if j != k and len(f) == len(e)
            ]
            near.sort(key=lambda x: (round(x[0], 12), x[1]))
            out += [(v, r + 1, w, -s) for r, (s, w) in enumerate(near[:nearest])]
    return sorted(out)


def compared(spark, rows, every=50, nearest=5):
    got = sorted(tuple(r) for r in g.nearest_neighbours(spark.createDataFrame(rows, VEC), nearest, every).collect())
    want = brute(rows, every, nearest)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert [r[3] for r in got] == pytest.approx([r[3] for r in want], abs=1e-12)
    return got


def vectors(seed, n, dim=8, start=0):
    rng = np.random.default_rng(seed)
    return [(start + k, [float(x) for x in v], k % 3, "x") for k, v in enumerate(rng.standard_normal((n, dim)))]


def test_small_tables_are_exact(spark):
    """Shards of a beam's size are searched whole, so ties, copies and lengths can be compared row by row."""
    rows = vectors(1, 150)
    rows += [(200 + k, rows[7][1], None, "x") for k in range(20)]  # many copies of one vector, one of them a query
    rows += [(300 + k, [2 * x for x in rows[9][1]], 1, "x") for k in range(2)]
    rows += vectors(2, 3, 5, 400) + vectors(3, 1, 3, 500)  # other lengths; one without candidates
    rows += [(600, None, 1, "x"), (650, [], 1, "x"), (700, [0.0] * 8, 1, "x"), (750, [float("nan")] + [1.0] * 7, 1, "x")]
    rows += [(800, [None] + [1.0] * 7, 1, "x"), (850, [float("inf")] * 8, 1, "x"), (None, rows[0][1], 1, "x"), (50, rows[3][1], 1, "x")]
    rows += [rows[100]]  # a query's row twice: each is a candidate of the other
    rows += [(900, [1e-30 * x for x in rows[9][1]], 1, "x"), (950, [1e30 * x for x in rows[11][1]], 1, "x")]
    got = compared(spark, rows)
    assert {r[0] for r in got} == {0, 50, 100, 200, 300, 400, 900, 950}
    assert sum(r[0] == 100 for r in got) == 10 and sum(r[0] == 400 for r in got) == 2


def test_empty_tables_and_lone_queries(spark):
    assert g.nearest_neighbours(spark.createDataFrame([], VEC)).count() == 0
    assert compared(spark, vectors(1, 1)) == []
    assert len(compared(spark, vectors(1, 3))) == 2


def test_shards_and_blocks_do_not_change_exact_answers(spark):
    rows = vectors(5, 260)
    frame = spark.createDataFrame(rows, VEC).selectExpr("vec_id", "embedding as e")
    want = brute(rows, 10, 4)
    graph = g.index(frame, 5, shard_rows=60)
    assert graph.select("shard").distinct().count() == 5
    asked = frame.where("vec_id % 10 = 0").withColumn("query", frame.vec_id)
    found = g.search(graph, asked, 4, beam=200, block_rows=7)
    assert sorted((r.query_id, r["rank"], r.vec_id) for r in found.collect()) == [r[:3] for r in want]


def test_recall_on_clusters_and_noise():
    """Every node can be reached, edges are few and listed once, and a beam finds nearly all neighbours."""
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((20, 24))
    near = np.repeat(centres, 60, axis=0) + 0.02 * rng.standard_normal((1200, 24))
    points = g.unit(np.concatenate([rng.standard_normal((1500, 24)), near])).astype(np.float32)
    edges, start = g.build_graph(points)
    seen = np.zeros(len(points), bool)
    g._reached(edges, start, seen)
    assert seen.all()
    for k, row in enumerate(edges):
        own = row[row >= 0].tolist()
        assert len(own) == len(set(own)) and k not in own
    queries = points[::25]
    found, near = g.beam_search(points, edges, start, queries, 96)
    assert (np.diff(near, axis=1) <= 0).all()
    truth = np.argsort(-(queries @ points.T), axis=1)[:, :6]
    recall = np.mean([len(set(t) & set(f)) / 6 for t, f in zip(truth.tolist(), found.tolist())])
    assert recall >= 0.97


def test_pruning_keeps_diverse_edges():
    angle = np.array([0.0, 0.1, 0.12, 0.14, -0.5, 0.16])
    points = np.stack([np.cos(angle), np.sin(angle)], axis=1).astype(np.float32)
    kept = g.pruned(points, np.array([0]), np.array([[1, 2, 3, 4, 5, 1, 0, -1]]), degree=4, relaxed=1.2)
    assert kept.tolist() == [[1, 4, -1, -1]]  # 2, 3 and 5 are nearer to 1 than to 0
