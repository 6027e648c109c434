"""Embedding near-dedup by spherical-cap filters from a random product code."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import pick, staged
from hourloom.llm.components import components
from hourloom.llm.simhash import spanning

COSINE, CODES, FILTERS, BUCKET, TILE_ROWS = 0.98, 2, 20, 32, 1024


class ProductCode:
    """size * size directions: every sum of a vector of one random half code and one of the other.

    The space is turned at random and cut into two halves; each half has `size` random vectors of squared
    length 1/2. A vector passes the filter of a direction if their inner product is at least `height`, which is set
    so that a unit vector passes `filters` of them on average, whatever the data look like.
    """

    def __init__(self, dim: int, size: int, filters: float, seed: int):
        rng = np.random.default_rng([seed, dim, size])
        self.turn = np.linalg.qr(rng.standard_normal((dim, dim)))[0]
        half = (dim + 1) // 2
        self.halves = [slice(0, half), slice(half, dim)]
        self.codes = [rng.standard_normal((size, s.stop - s.start)) for s in self.halves]
        for code in self.codes:
            code *= np.sqrt(0.5) / np.maximum(np.linalg.norm(code, axis=1, keepdims=True), 1e-12)
        angles = np.linspace(0, np.pi, 200_001)
        caps = np.cumsum(np.sin(angles) ** (dim - 2)) if dim > 2 else angles.copy()  # share of the sphere by angle
        self.height = float(np.cos(angles[np.searchsorted(caps / caps[-1], min(0.4, filters / size**2))]))
        self.size = size

    def passed(self, unit: np.ndarray) -> list[np.ndarray]:
        """The numbers of all filters that each row of `unit` passes, in order.

        List decoding: with the inner products of the second half in falling order, those that fit to one of the first
        half are its first few, so the work is that of the two half codes and of the filters found.
        """
        turned, out = unit @ self.turn, []
        first, second = (turned[:, s] @ c.T for s, c in zip(self.halves, self.codes, strict=True))
        falling = np.argsort(-second, axis=1)
        for a, b, order in zip(first, second, falling, strict=True):
            b = b[order]
            rows = np.nonzero(a + b[0] >= self.height)[0]
            counts = np.searchsorted(-b, a[rows] - self.height, side="right")
            ranks = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
            out.append(np.sort(np.repeat(rows, counts) * self.size + order[ranks]).astype(np.int64))
        return out


_codes: dict[tuple, ProductCode] = {}


def _passed(unit: np.ndarray, size: int, filters: float, codes: int) -> list[np.ndarray]:
    """The filters that each row passes in any of `codes` independent codes, in order."""
    dim, lists = unit.shape[1], []
    for seed in range(codes):
        key = (dim, size, filters, seed)
        if key not in _codes:
            _codes[key] = ProductCode(*key)
        lists.append([f + seed * size * size for f in _codes[key].passed(unit)])
    return [np.concatenate(own) for own in zip(*lists, strict=True)]


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Unit vectors in double precision; scaling first keeps very large and very small ones exact."""
    vectors = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _tile(x: dict, y: dict | None, number: int, cosine: float, code: tuple) -> pd.DataFrame | None:
    """Links of one tile, or between two, under filter `number`: node, links that no lower filter has, root.

    links counts vectors, copies included; root is the smallest node that the links of this tile reach.
    """
    sides = []
    for t in (x, x if y is None else y):
        e = np.asarray(t["es"], np.float64).reshape(len(t["nodes"]), -1)
        sides.append((np.asarray(t["nodes"]), np.asarray(t["sizes"]), _unit(e)))
    (n1, s1, u1), (n2, s2, u2) = sides
    near = u1 @ u2.T >= cosine - 1e-9
    if y is None:
        near = np.triu(near, 1)
    i, j = np.nonzero(near)
    exact = np.einsum("ij,ij->i", u1[i], u2[j]) >= cosine
    i, j = i[exact], j[exact]
    if not len(i):
        return None
    columns: dict[int, int] = {}
    marks = []
    for own, unit in ((i, u1), (j, u2)):
        rows, back = np.unique(own, return_inverse=True)
        lists = [[columns.setdefault(int(k), len(columns)) for k in f[f < number]] for f in _passed(unit[rows], *code)]
        marks.append((lists, back))
    (a, back1), (b, back2) = [
        (np.array([np.bincount(f, minlength=max(1, len(columns))) for f in lists], np.float32), back) for lists, back in marks
    ]
    new = (a @ b.T)[back1, back2] == 0
    edges = spanning(n1[i], n2[j])
    parts = [
        pd.DataFrame({"node": n1[i[new]], "links": s2[j[new]], "root": n1[i[new]]}),
        pd.DataFrame({"node": n2[j[new]], "links": s1[i[new]], "root": n2[j[new]]}),
        pd.DataFrame({"node": edges[:, 0], "links": 0, "root": edges[:, 1]}),
    ]
    return pd.concat(parts).groupby("node", as_index=False).agg({"links": "sum", "root": "min"})


def _linked(classes: DataFrame, code: tuple, cosine: float) -> DataFrame:
    """(node, links, root) from every tile of the filters' buckets."""

    def decode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["filters"] = None
            found = np.empty(len(batch), object)
            dims = batch["e"].map(len).to_numpy()
            for dim in np.unique(dims):
                rows = np.nonzero(dims == dim)[0]
                for at in range(0, len(rows), 256):
                    some = rows[at : at + 256]
                    unit = _unit(np.stack(batch["e"].to_numpy()[some]).astype(np.float64))
                    for r, f in zip(some, _passed(unit, *code), strict=True):
                        found[r] = f
            batch["filters"] = found
            yield batch

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    passed = staged(
        classes.mapInPandas(decode, ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", filters array<long>"), "passed"
    )
    rows = passed.withColumn("dim", F.size("e")).withColumn("filter", F.explode("filters")).drop("filters")
    key = ["label", "dim", "filter"]
    counts = passed.select("label", F.size("e").alias("dim"), F.explode("filters").alias("filter")).groupBy(key)
    cuts = counts.agg(F.ceil(F.count("*") / TILE_ROWS).alias("cuts"), F.count("*").alias("n")).where("n > 1").drop("n")
    tiles = staged(
        rows.join(cuts, key)
        .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")))
        .groupBy(*key, "cut", "cuts")
        .agg(
            F.collect_list("node").alias("nodes"),
            F.collect_list("size").alias("sizes"),
            F.flatten(F.collect_list("e")).alias("es"),
        ),
        "caps",
    )
    fields = ("nodes", "sizes", "es")

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                out = _tile(row, None, row["filter"], cosine, code)
                if out is not None:
                    yield out

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.to_dict("records"):
                out = _tile(row, {f: row[f"{f}2"] for f in fields}, row["filter"], cosine, code)
                if out is not None:
                    yield out

    schema = "node long, links long, root long"
    cut_up = tiles.where("cuts > 1")
    second = cut_up.select(*key, F.col("cut").alias("cut2"), *[F.col(f).alias(f"{f}2") for f in fields])
    pairs = cut_up.join(second, key).where("cut < cut2")
    spread = pairs.repartition(pairs.sparkSession.sparkContext.defaultParallelism * 4)
    return tiles.mapInPandas(alone, schema).unionByName(spread.mapInPandas(across, schema))


def near_duplicates(vectors: DataFrame, cosine: float = COSINE, codes: int = CODES, filters: float = FILTERS, bucket: float = BUCKET) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row of `vectors` (vec_id, embedding, label).

    Rows link if their labels are equal and not null and the cosine in double precision is at least `cosine`.
    Equal vectors of a label are put together first and counted, not compared. The others are listed under every filter
    that they pass, `filters` on average in each of `codes` product codes; the codes grow with the largest label, so that
    a filter holds about `bucket` unrelated vectors at any size, and buckets that near copies fill are cut into
    tiles. All vectors under a filter are compared; a pair that shares several filters counts under the lowest. A pair is
    missed only if it shares no filter; README has the measured recall. n_links counts rows, copies included.
    Null, empty or zero vectors, those with a null or non-finite component and rows with a null label link with nothing
    and are their own component. Vectors of different lengths never link. Repeated rows are rows of their own; rows that share
    a vec_id keep their own vectors. A null vec_id is kept, links, and is never kept by the dedup. An empty table
    gives an empty one.
    """
    rows = pick(vectors, vec_id="vec_id", e="embedding", label="label")
    sound = F.forall("e", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))) & F.exists("e", lambda v: v != 0)
    usable = F.coalesce(F.col("label").isNotNull() & sound, F.lit(False))
    named = staged(rows.withColumn("node", F.when(usable, F.xxhash64("label", "e"))), "vectors")
    classes = staged(
        named.where("node is not null").groupBy("node", "label", "e").agg(F.min("vec_id").alias("least"), F.count("*").alias("size")),
        "classes",
    )
    largest = classes.groupBy("label").count().agg(F.max("count")).first()[0] or 1
    size = max(16, int((largest * filters / bucket) ** 0.5) + 1)
    found = staged(_linked(classes, (size, filters, codes), cosine), "links")
    reached = components(found.where("node <> root").select(F.col("node").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    known = (
        classes.select("node", "least", "size")
        .join(links, "node", "left")
        .join(reached, "node", "left")
        .select(
            "node",
            "least",
            (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
            F.coalesce("component", "node").alias("component"),
        )
    )
    groups = known.groupBy("component").agg(F.min("least").alias("component_id"))
    known = known.join(groups, "component").select("node", "n_links", "component_id")
    out = named.select("vec_id", "node").join(known, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )
