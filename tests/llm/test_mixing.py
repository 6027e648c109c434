from __future__ import annotations

from collections import Counter

import pytest

from hourloom.llm import mixing
from tests.llm.helpers import AWKWARD, DOC


def plan(blocks):
    """Earliest deadline first, played slot by slot."""
    total, taken, out = sum(blocks), [0] * len(blocks), []
    for t in range(total):
        due = [
            (-(-(k + 1) * total // n), s) for s, (k, n) in enumerate(zip(taken, blocks, strict=True)) if k < n and k * total // n <= t
        ]
        s = min(due)[1]
        out.append((s, taken[s]))
        taken[s] += 1
    return out


@pytest.mark.parametrize("blocks", [[5], [3, 4, 5], [50, 1, 1, 1], [9, 1], [0, 2, 7], [1] * 12, [17, 5, 5, 3, 29, 1]])
def test_frames_are_fair_at_every_slot(spark, blocks):
    order = spark.createDataFrame([(blocks,)], "b array<int>").select(mixing.frame_order("b").alias("o")).first().o
    assert [tuple(x) for x in order] == plan(blocks)
    done, total = Counter(), sum(blocks)
    for t, (s, _) in enumerate(order, start=1):
        done[s] += 1
        assert all(abs(done[k] - t * n / total) < 1 for k, n in enumerate(blocks))


def expected(rows, parts, block_rows):
    """slot -> source and rows of it, played frame by frame."""
    sources = {}
    for doc_id, source in rows:
        u = (doc_id or 0) % 2**31 * mixing.SPREAD % 2**31
        sources.setdefault(source, []).append((u, doc_id is not None, doc_id or 0, doc_id))
    names = sorted(sources, key=lambda s: "" if s is None else "=" + s)
    blocks = {}
    for s in names:
        ids = [x[-1] for x in sorted(sources[s])]
        blocks[s] = [ids[k : k + block_rows] for k in range(0, len(ids), block_rows)]
    out, frame = [], 0
    while True:
        left = [max(0, min(parts[s], len(blocks[s]) - frame * parts[s])) for s in names]
        if not any(left):
            return out
        for s, k in plan(left):
            out.append((names[s], blocks[names[s]][frame * parts[names[s]] + k]))
        frame += 1


@pytest.mark.parametrize("parts", [{"a": 3, "b": 1, "c": 4, None: 2}, {"a": 1, "b": 9, "c": 1, None: 1}])
def test_schedule_matches_a_played_one(spark, monkeypatch, parts):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 7)
    monkeypatch.setattr(mixing, "RUN_BUCKETS", 3)
    rows = [(k * 3, "a" if k % 3 else "b") for k in range(170)] + [(1000 + k, "c") for k in range(11)] + [(2000, None), (None, "c")]
    df = spark.createDataFrame([(d, "t", "en", s, None, 0) for d, s in rows], DOC)
    got = mixing.schedule(df, parts, 4).select("slot", "place", "row.c0", "row.c3").collect()
    slots = {}
    for r in sorted(got, key=lambda r: (r.slot, r.place)):
        slots.setdefault(r.slot, (r.c3, []))[1].append(r.c0)
    assert [slots[k] for k in range(len(slots))] == expected(rows, parts, 4)
    assert len(got) == len(rows)


def test_mixture_keeps_rows_columns_and_order(spark):
    rows = [(k, f"t{k}", "en", "ab"[k % 5 == 0], "x", k) for k in range(60)] + AWKWARD
    df = spark.createDataFrame(rows, DOC)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    assert sorted(map(repr, out.collect())) == sorted(map(repr, df.collect()))
    assert mixing.mixed(spark.createDataFrame([], DOC)).count() == 0


def test_parts_must_be_positive(spark):
    with pytest.raises(ValueError):
        mixing.schedule(spark.createDataFrame(AWKWARD, DOC), {"a": 0})


@pytest.mark.parametrize("limit", [2_000, 10])
def test_default_weights_are_exact_with_many_sources_and_a_hot_one(spark, monkeypatch, limit):
    monkeypatch.setattr(mixing, "MAX_SOURCES", limit)
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 64)
    counts = {f"s{k:03}": 24 + k % 7 for k in range(200)} | {"hot": 2_700}
    rows = [(k * 1000 + d, s) for k, (s, n) in enumerate(counts.items()) for d in range(n)]
    got = mixing.schedule(spark.createDataFrame(rows, "doc_id long, source string")).select("slot", "place", "row.*").collect()
    assert sorted((r.c0, r.c1) for r in got) == sorted(rows)
    owner = {r.slot: r.c1 for r in got}
    assert sorted(owner) == list(range(sum(-(-n // 4) for n in counts.values())))
    assert len({(r.slot, r.place) for r in got}) == len(rows) and len({(r.slot, r.c1) for r in got}) == len(owner)
    roots = {s: n**0.5 for s, n in counts.items()}
    whole = int(min(-(-n // 4) / roots[s] for s, n in counts.items()) * sum(roots.values())) - 100  # slots before any source ends
    taken = Counter()
    for t in range(whole):
        taken[owner[t]] += 1
        share = {s: (t + 1) * roots[s] / sum(roots.values()) for s in ("hot", "s000", "s111")}
        assert all(abs(taken[s] - x) < 2 for s, x in share.items())


@pytest.mark.parametrize("counts", [{"a": 400, "b": 100}, {"a": 3_000, "b": 3, None: 40}, {f"s{k:02}": 20 + 9 * k for k in range(30)}])
def test_default_frames_are_played_earliest_deadline_first(spark, monkeypatch, counts):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 16)
    monkeypatch.setattr(mixing, "RUN_BLOCKS", 5)
    rows = [(k * 10_000 + d, s) for k, (s, n) in enumerate(counts.items()) for d in range(n)]
    got = mixing.schedule(spark.createDataFrame(rows, "doc_id long, source string")).select("slot", "place", "row.*").collect()
    assert sorted(r.c0 for r in got) == sorted(d for d, _ in rows)
    owner = {r.slot: r.c1 for r in got}
    names = {"" if s is None else "=" + s: s for s in counts}
    phased = mixing.phases({g: counts[s] for g, s in names.items()})
    by_weight = sorted(((b + phase) / n**0.5, g, b) for g, n, phase in phased for b in range(-(-n // 4)))
    size, want = mixing.frame_slots(len(counts)), []
    ends = {-(-n // 4) / n**0.5 for n in counts.values()}
    cuts = sorted({*range(0, len(by_weight), size), len(by_weight), *(sum(v < e for v, *_ in by_weight) for e in ends)})
    for start, after in zip(cuts, cuts[1:], strict=False):
        taken = Counter(g for _, g, _ in by_weight[start:after])  # in the order in which they come first
        want += [names[list(taken)[s]] for s, _ in plan(list(taken.values()))]
    assert [owner[t] for t in range(len(owner))] == want
    done = Counter()
    whole = int(min(-(-n // 4) / n**0.5 for n in counts.values()) * sum(n**0.5 for n in counts.values()))  # before any source ends
    for t in range(whole):
        done[owner[t]] += 1
        assert all(abs(done[s] - (t + 1) * n**0.5 / sum(m**0.5 for m in counts.values())) < 2 for s, n in counts.items())
