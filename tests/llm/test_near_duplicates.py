from __future__ import annotations

import math
import random

import numpy as np
import pytest
import xxhash

from hourloom.llm import simhash, sphere
from hourloom.llm.components import components
from tests.llm.helpers import AWKWARD, DOC, groups, lower, words


def test_components_of_paths_stars_and_loops(spark):
    rng = random.Random(1)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [(200, 200), (None, 5), (-7, 3)]
    edges += [(rng.randint(300, 400), rng.randint(300, 400)) for _ in range(60)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    pairs = {frozenset(e) for e in edges if None not in e}
    nodes = {n for e in pairs if len(e) == 2 for n in e}
    assert got == groups(sorted(nodes), lambda a, b: frozenset((a, b)) in pairs)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def fingerprint(text, size=3):
    w = words(lower(text))
    h = [xxhash.xxh64_intdigest(" ".join(w[k : k + size]).encode(), 42) for k in range(max(1, len(w) - size + 1))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def text_family(seed, n):
    rng = random.Random(seed)
    base = [f"w{rng.randint(0, 200)}" for _ in range(60)]
    out = []
    for _ in range(n):
        some = list(base)
        for _ in range(rng.randint(0, 4)):
            some[rng.randrange(len(some))] = f"x{rng.randint(0, 9)}"
        out.append(" ".join(some))
    return out


def test_simhash_matches_brute_force(spark):
    texts = [t for s in range(6) for t in text_family(s, 12)] + ["A b C", "a B c", "one two", "", None]
    rows = [(k, t, "en", "a", None, 0) for k, t in enumerate(texts)]
    prints = {k: fingerprint(t or "") for k, t in enumerate(texts)}
    want = groups(list(prints), lambda a, b: (prints[a] ^ prints[b]).bit_count() <= 2)
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOC)).collect()
    assert {(r.doc_id, r.fingerprint, r.component_id) for r in got} == {(k, f"{f:016x}", want[k]) for k, f in prints.items()}
    assert len(set(want.values())) < len(texts) - 10


@pytest.mark.parametrize("parts,tile_rows", [(1, 7), (2, 5), (4, 3), (8, 4096)])
def test_links_do_not_depend_on_cells_and_tiles(spark, parts, tile_rows):
    rng = random.Random(parts)
    near = [rng.getrandbits(64) for _ in range(8)]
    marks = {0, (1 << 64) - 1}
    while len(marks) < 80:
        marks.add(rng.choice(near) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) ^ (rng.getrandbits(1) << rng.randrange(64)))
    signed = sorted(m - (1 << 64) if m >> 63 else m for m in marks)
    prints = spark.createDataFrame([(m, [m]) for m in signed], "node long, f array<long>")
    found = components(simhash.links(prints, 2, parts, tile_rows=tile_rows))
    got = {r.node: r.component for r in found.collect()}
    want = groups(signed, lambda a, b: ((a ^ b) & ((1 << 64) - 1)).bit_count() <= 2)
    assert {n: got.get(n, n) for n in signed} == want


def test_simhash_of_awkward_rows(spark):
    got = simhash.near_duplicates(spark.createDataFrame(AWKWARD, DOC)).collect()
    assert len(got) == len(AWKWARD)
    of = {(r.doc_id, r.fingerprint): r.component_id for r in got}
    assert of[1, "0" * 16] == of[2, "0" * 16] == of[3, "0" * 16] == 1
    assert of[7, f"{fingerprint(AWKWARD[5][1]):016x}"] == 6
    assert simhash.near_duplicates(spark.createDataFrame([], DOC)).count() == 0


def test_wide_fingerprints_find_near_copies(spark):
    rng = random.Random(5)
    base = [[f"w{rng.randint(0, 3000)}" for _ in range(200)] for _ in range(5)]
    rows = []
    for k, w in enumerate(base):
        for c in range(4):
            some = list(w)
            for at in range(c):
                some[17 + 60 * at] = "new"  # each changes five of 196 shingles
            rows.append((10 * k + c, " ".join(some), "en", "a", None, 0))
    got = simhash.near_duplicates(spark.createDataFrame(rows, DOC), 5, 18, 1, 8, 84, True).collect()
    assert {r.doc_id: r.component_id for r in got} == {r[0]: r[0] // 10 * 10 for r in rows}


def test_similar_sets_share_a_key():
    rng = np.random.default_rng(9)
    for n in range(1, 60):
        whole = rng.integers(0, 2**63, n, dtype=np.uint64)
        for lost in range(n):
            h, part = np.unique(whole), np.unique(whole[lost:])
            if len(part) / len(h) >= 0.8:
                assert set(simhash.set_keys(h, 0.8)) & set(simhash.set_keys(part, 0.8))


@pytest.mark.parametrize("tile_rows", [3, 4096])
def test_keyed_links_compare_where_a_key_is_shared(spark, tile_rows):
    rng = random.Random(tile_rows)
    base = [[rng.getrandbits(63) for _ in range(2)] for _ in range(3)]
    prints = {k: [w ^ (1 << rng.randrange(60)) for w in rng.choice(base)] for k in range(90)}
    keys = [(k, rng.randrange(40)) for k in prints] + [(k, 100) for k in range(80) if k % 3 == 0]
    keys += keys[:10]
    shared = {k: {key for node, key in keys if node == k} for k in prints}
    near = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b], strict=True)) <= 4
    want = groups(list(prints), lambda a, b: bool(shared[a] & shared[b]) and near(a, b))
    assert want != groups(list(prints), near)
    nodes = spark.createDataFrame(list(prints.items()), "node long, f array<long>")
    found = components(simhash.keyed_links(nodes, spark.createDataFrame(keys, "node long, key long"), 4, tile_rows))
    got = {r.node: r.component for r in found.collect()}
    assert {n: got.get(n, n) for n in prints} == want


def test_reached_connects_what_links():
    rng = random.Random(8)
    base = [[rng.getrandbits(63) for _ in range(2)] for _ in range(4)]
    prints = [[w ^ sum(1 << b for b in rng.sample(range(63), 3)) for w in rng.choice(base)] for _ in range(200)]
    prints += [[rng.getrandbits(63) for _ in range(2)] for _ in range(50)]
    linked = lambda a, b: sum((x ^ y).bit_count() for x, y in zip(prints[a], prints[b], strict=True)) <= 6
    edges = simhash._reached(list(range(250)), [w for f in prints for w in f], 6).tolist()
    assert all(linked(a, b) for a, b in edges)
    pairs = {frozenset(e) for e in edges}
    want = groups(list(range(250)), linked)
    assert groups(list(range(250)), lambda a, b: frozenset((a, b)) in pairs) == want and len(edges) == 250 - len(set(want.values()))


def test_unrelated_documents_are_not_compared(spark, monkeypatch):
    seen, write = {}, simhash.staged
    monkeypatch.setattr(simhash, "staged", lambda df, name: seen.setdefault(name, write(df, name)))
    texts = [" ".join(f"d{k}w{w}" for w in range(60)) for k in range(40)]
    rows = [(k, t, "en", "a", None, 0) for k, t in enumerate([*texts, texts[7] + " more"])]
    got = simhash.similar_documents(spark.createDataFrame(rows, DOC), 0.8, 5, 8, 150).collect()
    assert {r.doc_id: r.component_id for r in got} == {r[0]: 7 if r[0] == 40 else r[0] for r in rows}
    assert seen["shared-keys"].select("node").distinct().count() == 2


VECTOR = "vec_id long, embedding array<float>, label int, Label2 int"


def near_vectors(seed, n, groups_of, dim=64, spread=0.012):
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((groups_of, dim))
    centres /= np.linalg.norm(centres, axis=1, keepdims=True)
    return np.vstack([centres[rng.integers(groups_of, size=n)] + spread * rng.standard_normal((n, dim)), rng.standard_normal((n, dim))])


def brute(rows, cosine=0.98):
    def unit(e):
        if not e or any(x is None or not math.isfinite(x) for x in e) or not any(e):
            return None
        v = np.array(e, np.float32).astype(np.float64)
        return v / np.linalg.norm(v)

    units = [unit(r[1]) for r in rows]
    linked = [
        [
            a != b
            and rows[a][2] is not None
            and rows[a][2] == rows[b][2]
            and units[a] is not None
            and units[b] is not None
            and len(units[a]) == len(units[b])
            and float(units[a] @ units[b]) >= cosine
            for b in range(len(rows))
        ]
        for a in range(len(rows))
    ]
    return linked


def test_caps_find_the_links_of_brute_force(spark):
    vectors = near_vectors(3, 250, 12)
    rows = [(k, [float(x) for x in v], k % 3, None) for k, v in enumerate(vectors)]
    rows += [(1000 + k, rows[k][1], rows[k][2], None) for k in range(20)]  # copies
    linked = brute(rows)
    got = {r.vec_id: r for r in sphere.near_duplicates(spark.createDataFrame(rows, VECTOR)).collect()}
    want = {r[0]: sum(linked[k]) for k, r in enumerate(rows)}
    found = sum(r.n_links for r in got.values())
    assert all(got[v].n_links <= want[v] for v in want), "a link below the threshold"
    assert found >= 0.99 * sum(want.values()) > 1000
    ids = [r[0] for r in rows]
    place = {v: k for k, v in enumerate(ids)}
    assert {v: got[v].component_id for v in ids} == groups(ids, lambda a, b: linked[place[a]][place[b]])
    assert all(r.kept == (r.vec_id == r.component_id) for r in got.values())


def test_large_buckets_are_cut_without_counting_twice(spark, monkeypatch):
    monkeypatch.setattr(sphere, "TILE_ROWS", 8)
    vectors = near_vectors(4, 60, 1)[:60]
    rows = [(k, [float(x) for x in v], 0, None) for k, v in enumerate(vectors)]
    linked = brute(rows)
    got = {r.vec_id: r.n_links for r in sphere.near_duplicates(spark.createDataFrame(rows, VECTOR)).collect()}
    assert got == {k: sum(linked[k]) for k in range(60)}


def test_awkward_vectors(spark):
    rows = [
        (1, None, 0, None),
        (2, [], 0, None),
        (3, [0.0, 0.0], 0, None),
        (4, [1.0, None], 0, None),
        (5, [1.0, float("nan")], 0, None),
        (6, [float("inf"), 1.0], 0, None),
        (7, [1.0, 2.0], None, None),
        (8, [1.0, 2.0], 0, None),
        (9, [1e-30, 2e-30], 0, None),
        (10, [1e30, 2e30], 0, None),
        (8, [1.0, 2.0], 0, None),
        (11, [1.0, 2.0, 0.0], 0, None),
        (12, [-1.0, -2.0], 0, None),
    ]
    got = sorted(((r.vec_id, r.n_links, r.component_id) for r in sphere.near_duplicates(spark.createDataFrame(rows, VECTOR)).collect()))
    alone = [(k, 0, k) for k in (1, 2, 3, 4, 5, 6, 7, 11, 12)]
    assert got == sorted([*alone, (8, 3, 8), (8, 3, 8), (9, 3, 8), (10, 3, 8)])
    assert sphere.near_duplicates(spark.createDataFrame([], VECTOR)).count() == 0
