"""Nearest neighbours by robust-pruned graphs, one for each shard of the vectors, searched with a beam."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import pick, staged

NEAREST, EVERY, SHARD_ROWS, BLOCK_ROWS = 5, 50, 8_192, 8_192
# Edges kept by a pruning, edges that a node may gather before it is pruned again, beams, and how much nearer to an edge
# that is kept than to the node a candidate has to be to be left out.
DEGREE, ROOM, BUILD_BEAM, BEAM, RELAXED, BATCH = 32, 48, 100, 256, 1.2, 512


def unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaling first keeps very large and very small ones exact."""
    vectors = np.asarray(vectors, np.float64)
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def beam_search(points: np.ndarray, edges: np.ndarray, start: int, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
    """(nodes, nearness) of the `beam` nearest nodes that a greedy walk meets, nearest first, -1 where there are fewer.

    All queries step together: each expands its nearest node that is not expanded yet, until its beam holds none.
    """
    n = len(queries)
    nodes, near = np.full((n, beam), -1), np.full((n, beam), -np.inf, np.float32)
    done = np.zeros((n, beam), bool)
    nodes[:, 0], near[:, 0] = start, queries @ points[start]
    seen = np.zeros((n, len(points)), bool)
    seen[:, start] = True
    rows = np.arange(n)
    while len(rows):
        waits = ~done[rows] & (nodes[rows] >= 0)
        going = waits.any(axis=1)
        rows, waits = rows[going], waits[going]
        at = waits.argmax(axis=1)
        done[rows, at] = True
        new = edges[nodes[rows, at]]
        fresh = (new >= 0) & ~seen[rows[:, None], new]
        seen[rows[:, None], np.where(fresh, new, start)] = True
        close = np.where(fresh, np.matmul(points[new], queries[rows][:, :, None])[:, :, 0], -np.inf).astype(np.float32)
        all_near = np.concatenate([near[rows], close], axis=1)
        order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
        near[rows] = np.take_along_axis(all_near, order, axis=1)
        nodes[rows] = np.take_along_axis(np.concatenate([nodes[rows], np.where(fresh, new, -1)], axis=1), order, axis=1)
        done[rows] = np.take_along_axis(np.concatenate([done[rows], np.zeros(fresh.shape, bool)], axis=1), order, axis=1)
    return nodes, near


def pruned(points: np.ndarray, own: np.ndarray, found: np.ndarray, degree: int = DEGREE, relaxed: float = RELAXED) -> np.ndarray:
    """Edges of each node of `own` out of its candidates (a row of `found`, -1 for none), nearest first, at most `degree`.

    The nearest candidate left becomes an edge; candidates that are `relaxed` times nearer to it than to the node are left out.
    """
    order = np.sort(found, axis=1)
    order[:, 1:][order[:, 1:] == order[:, :-1]] = -1
    order[order == own[:, None]] = -1
    near = np.where(order >= 0, np.matmul(points[order], points[own][:, :, None])[:, :, 0], -np.inf)
    by = np.argsort(-near, axis=1, kind="stable")
    order, near = np.take_along_axis(order, by, axis=1), np.take_along_axis(near, by, axis=1)
    vectors = points[order]
    between = relaxed**2 * (1 - np.matmul(vectors, vectors.transpose(0, 2, 1)))
    apart, alive = 1 - near, order >= 0
    out, rows = np.full((len(own), degree), -1), np.arange(len(own))
    for k in range(degree):
        first = alive.argmax(axis=1)
        some = alive[rows, first]
        if not some.any():
            break
        out[some, k] = order[rows[some], first[some]]
        alive &= between[rows, first] > apart
        alive[rows, first] = False
    return out


def _add_back(points: np.ndarray, edges: np.ndarray, heads: np.ndarray, tails: np.ndarray) -> None:
    """Add the edges heads -> tails; nodes without room are pruned, which makes some."""
    while len(heads):
        new = ~(edges[heads] == tails[:, None]).any(axis=1)  # a node is listed once
        pairs = np.unique(np.stack([heads[new], tails[new]]), axis=1)
        heads, tails = pairs[0], pairs[1]
        place = np.arange(len(heads)) - np.searchsorted(heads, heads)
        now = place < ROOM - DEGREE
        some, number = np.unique(heads[now], return_inverse=True)
        wide = np.concatenate([edges[some], np.full((len(some), ROOM - DEGREE), -1)], axis=1)
        wide[number, ROOM + place[now]] = tails[now]
        full = (wide >= 0).sum(axis=1) > ROOM
        for at in range(0, int(full.sum()), BATCH):
            rows = np.nonzero(full)[0][at : at + BATCH]
            edges[some[rows], :DEGREE] = pruned(points, some[rows], wide[rows])
            edges[some[rows], DEGREE:] = -1
        rest = wide[~full]
        edges[some[~full]] = np.take_along_axis(rest, np.argsort(rest < 0, axis=1, kind="stable"), axis=1)[:, :ROOM]
        heads, tails = heads[~now], tails[~now]


def _reached(edges: np.ndarray, start: int, seen: np.ndarray) -> None:
    wave = np.array([start])
    seen[start] = True
    while len(wave):
        wave = np.unique(edges[wave])
        wave = wave[wave >= 0]
        wave = wave[~seen[wave]]
        seen[wave] = True


def build_graph(points: np.ndarray) -> tuple[np.ndarray, int]:
    """(edges, start) over unit vectors: up to ROOM edges of each node, -1 for none; every node can be reached from `start`.

    Nodes come in batches that double up to BATCH: greedy searches on the graph so far, and the batch itself,
    propose their neighbours, pruning keeps diverse ones, and the edges are added backwards too.
    """
    n = len(points)
    edges = np.full((n, ROOM), -1)
    start = int(np.argmax(points @ points.mean(axis=0)))
    order = np.random.default_rng(0).permutation(n)
    order = np.concatenate([[start], order[order != start]])
    at = 1
    while at < n:
        own = order[at : at + min(BATCH, at + 63)]
        found, _ = beam_search(points, edges, start, points[own], min(BUILD_BEAM, at))
        among = points[own] @ points[own].T
        k = min(len(own), DEGREE)
        mates = own[np.argpartition(-among, k - 1, axis=1)[:, :k]]
        edges[own, :DEGREE] = pruned(points, own, np.concatenate([found, mates], axis=1))
        rows, places = np.nonzero(edges[own] >= 0)
        _add_back(points, edges, edges[own[rows], places], own[rows])
        at += len(own)
    seen = np.zeros(n, bool)
    _reached(edges, start, seen)
    while not seen.all():
        lost = int(np.argmin(seen))
        free = seen & (edges[:, -1] < 0)
        if not free.any():
            edges = np.concatenate([edges, np.full((n, 1), -1)], axis=1)
            free = seen
        joint = int(np.argmax(np.where(free, points @ points[lost], -np.inf)))
        edges[joint, -1] = lost
        _reached(edges, lost, seen)
    return edges, start


def _sound(e: str) -> Column:
    """Vectors that have a direction: no null or non-finite component, and one that is not zero."""
    finite = F.forall(e, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.coalesce(finite & F.exists(e, lambda v: v != 0), F.lit(False))


def index(vectors: DataFrame, members: int = NEAREST + 1, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The index of `vectors` (vec_id, e): a row for each different vector with its edges in its shard's graph.

    Columns dim, shard, no, start, ids, e, edges. Equal vectors are one node whose ids are the smallest `members` vec_ids, all that a
    search for fewer neighbours can need; shards are dealt at random, about `shard_rows` nodes each, and each is built in one task.
    """
    place = F.row_number().over(Window.partitionBy("node", "e").orderBy("vec_id"))
    first = vectors.withColumn("node", F.xxhash64("e")).withColumn("place", place).where(F.col("place") <= members)
    nodes = staged(first.groupBy("node", "e").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")), "nodes")
    sized = nodes.withColumn("dim", F.size("e"))
    dims = sized.groupBy("dim").agg(F.ceil(F.count("*") / shard_rows).alias("shards"))
    dealt = sized.join(dims, "dim").withColumn("shard", F.pmod(F.xxhash64("node", "dim"), F.col("shards")).cast("int"))
    tasks = max(1, dims.agg(F.sum("shards")).first()[0] or 0)  # small in bytes, long in work: one task a shard

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("node", kind="stable")
        edges, start = build_graph(unit(np.stack(rows["e"].to_numpy())).astype(np.float32))
        return pd.DataFrame(
            {
                "dim": rows["dim"].to_numpy(),
                "shard": rows["shard"].to_numpy(),
                "no": np.arange(len(rows)),
                "start": start,
                "ids": rows["ids"].to_numpy(),
                "e": rows["e"].to_numpy(),
                "edges": [row[row >= 0] for row in edges],
            }
        )

    e_type = nodes.schema["e"].dataType.simpleString()
    return dealt.repartition(tasks, "dim", "shard").groupBy("dim", "shard").applyInPandas(
        build, f"dim int, shard int, no int, start int, ids array<long>, e {e_type}, edges array<int>"
    )


def search(graph: DataFrame, queries: DataFrame, nearest: int = NEAREST, beam: int = BEAM, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(query, query_id, rank, vec_id, score) for `queries` (query, vec_id, e): query tells rows of one vec_id apart.

    Every shard of `graph` is searched for every query with as many components: blocks of queries meet shards of bounded size, pair
    by pair. A pair returns its `nearest`, scored in double precision on the vectors as given; the pairs' answers are merged by
    query. One row with the query's vec_id and vector is the query itself and is left out.
    """
    queries = queries.withColumn("dim", F.size("e"))
    shards = graph.groupBy("dim").agg(F.max("shard").alias("last_shard"))
    blocks = queries.groupBy("dim").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("blocks"))
    block = F.pmod(F.xxhash64("query"), F.col("blocks")).cast("int")
    wanted = (
        queries.join(blocks, "dim")
        .withColumn("block", block)
        .join(shards, "dim")
        .withColumn("shard", F.explode(F.sequence(F.lit(0), "last_shard")))
        .select("dim", "shard", "block", "query", "vec_id", "e")
    )
    sides = graph.join(blocks, "dim").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    sides = sides.select("dim", "shard", "block", "no", "start", "ids", "e", "edges")

    def answer(index_rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = {"query": [], "query_id": [], "vec_id": [], "score": []}
        if len(index_rows) and len(asked):
            index_rows = index_rows.sort_values("no", kind="stable")
            points, q = (unit(np.stack(side["e"].to_numpy())) for side in (index_rows, asked))
            edges = np.full((len(points), max(1, max(map(len, index_rows["edges"])))), -1)
            for row, own in zip(edges, index_rows["edges"], strict=True):
                row[: len(own)] = own
            ids, start, fast = index_rows["ids"].to_numpy(), int(index_rows["start"].iloc[0]), points.astype(np.float32)
            for at in range(0, len(q), BATCH):
                some = q[at : at + BATCH]
                found, _ = beam_search(fast, edges, start, some.astype(np.float32), min(beam, len(points)))
                scores = np.matmul(points[found], some[:, :, None])[:, :, 0]
                for k, (query, own) in enumerate(zip(asked["query"].iloc[at:], asked["vec_id"].iloc[at:])):
                    if k == len(some):
                        break
                    best = best_rows(found[k], scores[k], ids, int(own), np.asarray(asked["e"].iloc[at + k]), index_rows["e"], nearest)
                    for score, vec_id in best:
                        out["query"].append(query)
                        out["query_id"].append(own)
                        out["vec_id"].append(vec_id)
                        out["score"].append(score)
        return pd.DataFrame(out)

    key = ["dim", "shard", "block"]
    tasks = max(1, sides.select(*key).distinct().count())
    pairs = sides.repartition(tasks, *key).groupBy(*key).cogroup(wanted.repartition(tasks, *key).groupBy(*key))
    found = pairs.applyInPandas(answer, "query long, query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= nearest).select("query", "query_id", "rank", "vec_id", "score")


def best_rows(found, scores, ids, own_id: int, own: np.ndarray, vectors: pd.Series, nearest: int) -> list[tuple[float, int]]:
    """The `nearest` (score, vec_id) of the nodes found, nodes of equal vectors by vec_id, without one row of the query itself."""
    rows, kept = [], 0
    order = np.argsort(-scores, kind="stable")
    for k in order:
        if found[k] < 0:
            continue
        if kept >= nearest and scores[k] < rows[nearest - 1][0]:
            break
        members = list(ids[found[k]])
        if own_id in members and np.array_equal(vectors.iloc[found[k]], own):
            members.remove(own_id)
        rows += [(float(scores[k]), int(m)) for m in members]
        kept = len(rows)
    return sorted(rows, key=lambda row: (-row[0], row[1]))[:nearest]


def nearest_neighbours(vectors: DataFrame, nearest: int = NEAREST, every: int = EVERY) -> DataFrame:
    """(query_id, rank, vec_id, score) of the `nearest` rows by cosine to each row whose vec_id `every` divides.

    Candidates are all rows but the query's own, those of equal cosine by vec_id. Null or zero vectors, those with a null or
    non-finite component and rows without a vec_id take no part; vectors of different lengths are never compared. Rows that
    repeat a vec_id are rows of their own: each one that is a query is answered, and a repeated row is a candidate
    for the other. A table with fewer candidates gives all of them, an empty one gives no row. Other columns are ignored.
    """
    rows = pick(vectors, vec_id="vec_id", e="embedding").where(_sound("e") & F.col("vec_id").isNotNull())
    rows = staged(rows.withColumn("vec_id", F.col("vec_id").cast("long")).withColumn("query", F.monotonically_increasing_id()), "rows")
    graph = staged(index(rows.select("vec_id", "e"), nearest + 1), "graph")
    asked = rows.where(F.col("vec_id") % every == 0)
    return search(graph, asked, nearest).select("query_id", "rank", "vec_id", "score")
