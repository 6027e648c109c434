"""SimHash near-dedup: fingerprints compared exactly in tiles, tiles of too different bit counts left out; on demand the
fingerprints of sets that share a key only choose what is compared by its shingle sets."""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from hourloom.llm.common import pick, staged
from hourloom.llm.components import components

SEED, SHINGLE, RADIUS = 42, 3, 2
TILE_ROWS = 4096
# Pairs of first words that are compared at once: they stay in a core's cache.
BLOCK_PAIRS = 32_768
# A tile of shingle sets: rows, hashes; rows compared at once, hashes counted at once.
SET_ROWS, SET_HASHES, BLOCK_ROWS, BLOCK_HASHES = 1024, 400_000, 128, 8192
# ASCII letters lower-cased, the white space characters made spaces.
_FOLD = bytes(32 if b in b" \t\n\x0b\x0c\r" else b + 32 if 65 <= b <= 90 else b for b in range(256))
_LANES = np.uint64(0x0101010101010101)


def shingle_hashes(text: str | None, size: int) -> np.ndarray:
    """XXH64 (seed 42) of every run of `size` words, repeats included; of all words if there are fewer."""
    parts = (text or "").encode("utf-8", "surrogatepass").translate(_FOLD).split()
    if not parts:
        return np.empty(0, np.uint64)
    flat = b" ".join(parts)
    ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = max(1, len(parts) - size + 1)
    digest = xxhash.xxh64_intdigest
    places = zip(starts[:n].tolist(), ends[min(size, len(parts)) - 1 :].tolist(), strict=True)
    return np.fromiter((digest(flat[i:j], SEED) for i, j in places), np.uint64, n)


def _mixed(h: np.ndarray, k: int) -> np.ndarray:
    """Further 64 bits for the same shingles (a bijective mixing step)."""
    h = h + np.uint64((k * 0x9E3779B97F4A7C15) & 0xFFFFFFFFFFFFFFFF)
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def majority(h: np.ndarray) -> int:
    """64 bits: 1 where over half of the hashes have a 1. No hash gives 0."""
    counts = np.zeros(64, np.int64)  # of bit 8 * byte + shift at [shift * 8 + byte]
    for k in range(8):
        lanes = (h >> np.uint64(k)) & _LANES
        for at in range(0, len(h), 255 * 512):
            part = lanes[at : at + 255 * 512]
            sums = np.add.reduceat(part, np.arange(0, len(part), 255))  # each byte counts up to 255
            counts[k * 8 : k * 8 + 8] += sums.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    bits = 2 * counts > len(h)
    places = (np.arange(8)[None, :] * 8 + np.arange(8)[:, None]).ravel()
    return int(sum(1 << int(p) for p in places[bits]))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, words: int = 1, distinct: bool = False) -> DataFrame:
    """(doc_id, f): the fingerprint of every row of `docs` (doc_id, text), as `words` 64-bit words in an array.

    Texts without a word (null ones too) have fingerprint zero. The first word is the plain
    SimHash; the others come from the same hashes, mixed anew. With `distinct`, a repeated shingle
    counts once. Rows, also repeated ones, are kept as they are.
    """
    rows = pick(docs, doc_id="doc_id", text="text")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch.pop("text"):
                h = shingle_hashes(text, shingle)
                h = np.unique(h) if distinct else h
                out.append([_signed(majority(_mixed(h, k) if k else h)) for k in range(words)])
            batch["f"] = out
            yield batch

    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, f array<long>")


def _steps(parts: int, radius: int) -> list[tuple[int, ...]]:
    """Differences of bit counts within the radius, one of each pair d, -d."""
    around = range(-radius, radius + 1)
    return [d for d in product(around, repeat=parts) if sum(map(abs, d)) <= radius and d >= (0,) * parts]


def links(prints: DataFrame, radius: int = RADIUS, parts: int = 4, full_radius: int | None = None, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Pairs (a, b) of nodes that connect all fingerprints of `prints` (node, f) that link.

    Fingerprints link if their first words differ in at most `radius` bits and, if given, all words
    together in at most `full_radius`. The first word is cut into `parts` pieces; fingerprints with the same bit
    counts of the pieces form a cell, and a cell is cut by hash into tiles of about `tile_rows`. Bit counts differ
    by at most as much as the fingerprints, so only tiles of cells within the radius (sum over the pieces)
    are compared, each pair of tiles once, every fingerprint of one with every one of the other by exclusive or
    and bit counts. A pair of tiles gives one edge for each fingerprint that it connects, not all its pairs.
    `prints` needs distinct nodes; a tile pair is one row, so no task holds more than its share of tiles.
    """
    if 64 % parts:
        raise ValueError("parts must divide 64")
    width = 64 // parts
    mask = (1 << width) - 1
    pieces = [
        F.bit_count(F.shiftrightunsigned(F.get("f", F.lit(0)), k * width).bitwiseAND(F.lit(mask if width < 64 else -1))).cast("int")
        for k in range(parts)
    ]
    cells = prints.select("node", "f", F.array(*pieces).alias("cell"))
    sizes = cells.groupBy("cell").agg(F.ceil(F.count("*") / tile_rows).alias("cuts"))
    tiles = staged(
        cells.join(sizes, "cell")
        .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")))
        .groupBy("cell", "cut")
        .agg(F.collect_list("node").alias("nodes"), F.flatten(F.collect_list("f")).alias("fs")),
        "tiles",
    )
    steps = F.explode(F.array(*[F.array(*map(F.lit, d)) for d in _steps(parts, radius)]))
    left = (
        tiles.select(F.col("cell").alias("own"), F.col("cut").alias("own_cut"), "nodes", "fs", steps.alias("d"))
        .withColumn("cell", F.zip_with("own", "d", lambda x, y: x + y))
        .drop("d")
    )
    right = tiles.select("cell", "cut", F.col("nodes").alias("nodes2"), F.col("fs").alias("fs2"))
    pairs = left.join(right, "cell").where("own <> cell or own_cut <= cut")
    pairs = pairs.select("nodes", "fs", "nodes2", "fs2")

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [_tile(*row, radius, full_radius) for row in zip(*(batch[c] for c in ("nodes", "fs", "nodes2", "fs2")), strict=True)]
            found = [x for x in found if len(x)]
            if found:
                yield pd.DataFrame(np.concatenate(found), columns=["a", "b"])

    return pairs.mapInPandas(compare, "a long, b long")


def _tile(nodes, fs, nodes2, fs2, radius: int, full_radius: int | None) -> np.ndarray:
    """Edges (node, node) that connect whatever links between two tiles."""
    x = np.asarray(fs, np.int64).view(np.uint64).reshape(len(nodes), -1)
    y = np.asarray(fs2, np.int64).view(np.uint64).reshape(len(nodes2), -1)
    rows, columns = [], []
    step = max(1, BLOCK_PAIRS // max(1, len(y)))
    for at in range(0, len(x), step):
        i, j = np.nonzero(np.bitwise_count(x[at : at + step, :1] ^ y[None, :, 0]) <= radius)
        if full_radius is not None and len(i):
            near = np.bitwise_count(x[at + i] ^ y[j]).sum(axis=1, dtype=np.int64) <= full_radius
            i, j = i[near], j[near]
        rows.append(i + at)
        columns.append(j)
    a, b = np.asarray(nodes)[np.concatenate(rows)], np.asarray(nodes2)[np.concatenate(columns)]
    apart = a != b
    return spanning(a[apart], b[apart])


def spanning(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """One edge (node, smallest node of its component) for each node that is not that smallest one."""
    names, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    i, j = ends[: len(a)], ends[len(a) :]
    root = np.arange(len(names))
    while True:
        least = np.minimum(root[i], root[j])
        new = root.copy()
        np.minimum.at(new, root[i], least)
        np.minimum.at(new, root[j], least)
        new = new[new]
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, root):
            break
        root = new
    other = root != np.arange(len(names))
    return np.stack([names[other], names[root[other]]], axis=1)


def set_keys(h: np.ndarray, similarity: float) -> np.ndarray:
    """The smallest hashes of a set (in order), as many as it can lack of a similar one and one more.

    Sets of a Jaccard similarity of at least `similarity` share that part of the larger one at least, so the smallest hash that
    they share is among these of both: no similar pair is without a common key.
    """
    return h[: len(h) - math.ceil(similarity * len(h) - 1e-9) + 1]


def keyed_links(prints: DataFrame, keys: DataFrame, full_radius: int, tile_rows: int = TILE_ROWS) -> DataFrame:
    """Pairs (a, b) that connect all nodes of `prints` (node, f) that share a key of `keys` (node, key) and link.

    Fingerprints link if all their words together differ in at most `full_radius` bits. Most keys have one node and are
    dropped by one shuffle of the keys alone; only the others get their fingerprints. A key is cut by hash into tiles of about
    `tile_rows`, and each tile compared with itself and with the later ones, so a common key is dealt like many others.
    `prints` needs distinct nodes; a (node, key) may repeat.
    """
    own = Window.partitionBy("key")
    marked = keys.select("node", "key", F.min("node").over(own).alias("low"), F.max("node").over(own).alias("high"))
    shared = staged(marked.where("low < high").select("node", "key").distinct(), "shared-keys")
    cuts = shared.groupBy("key").agg(F.ceil(F.count("*") / tile_rows).cast("int").alias("cuts"))
    tiles = staged(
        shared.join(prints.select("node", "f"), "node")
        .join(cuts, "key")
        .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
        .groupBy("key", "cut", "cuts")
        .agg(F.collect_list("node").alias("nodes"), F.flatten(F.collect_list("f")).alias("fs")),
        "key-tiles",
    )

    def alone(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = _small_tiles(batch["nodes"], batch["fs"], full_radius)
            if len(found):
                yield pd.DataFrame(found, columns=["a", "b"])

    def across(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for nodes, fs, nodes2, fs2 in batch.itertuples(index=False, name=None):
                found = _reached(np.concatenate([nodes, nodes2]), np.concatenate([fs, fs2]), full_radius)
                if len(found):
                    yield pd.DataFrame(found, columns=["a", "b"])

    # The pairs of tiles are made from the keys, as in set_links.
    later = tiles.where("cut + 1 < cuts").select("key", "cut", F.explode(F.sequence(F.col("cut") + 1, F.col("cuts") - 1)).alias("cut2"))
    first = tiles.where("cuts > 1").select("key", "cut", "nodes", "fs")
    second = first.toDF("key", "cut2", "nodes2", "fs2")
    pairs = later.join(first, ["key", "cut"]).join(second, ["key", "cut2"]).select("nodes", "fs", "nodes2", "fs2")
    schema = "a long, b long"
    return tiles.select("nodes", "fs").mapInPandas(alone, schema).unionByName(pairs.mapInPandas(across, schema))


def _reached(nodes, fs, full_radius: int) -> np.ndarray:
    """Edges (node, node) that connect whatever links among `nodes`: a node that is reached is not compared as a target again,
    so a large group of near copies costs little more than one row of its pairs."""
    names = np.asarray(nodes, np.int64)
    bits = np.asarray(fs, np.int64).view(np.uint64).reshape(len(names), -1)
    left, rest = np.arange(len(names)), bits.T.copy()
    waiting, found = [], [np.empty((0, 2), np.int64)]
    while len(left):
        if waiting:
            at = waiting.pop()
        else:
            at, left, rest = left[0], left[1:], rest[:, 1:]
        near = np.bitwise_count(rest ^ bits[at][:, None]).sum(axis=0, dtype=np.uint16) <= full_radius
        if near.any():
            new = left[near]
            waiting.extend(new.tolist())
            found.append(np.stack([names[new], np.full(len(new), names[at])], axis=1))
            left, rest = left[~near], rest[:, ~near]
    return np.concatenate(found)


def _small_tiles(nodes, fs, full_radius: int) -> np.ndarray:
    """Edges (node, node) that connect whatever links inside each of many tiles; tiles of one size are compared together."""
    sizes = np.array([len(n) for n in nodes], np.int64)
    found = [np.empty((0, 2), np.int64)]
    for size in np.unique(sizes[sizes > 1]).tolist():
        at = np.flatnonzero(sizes == size)
        if size > 64:
            found += [_reached(nodes.iloc[k], fs.iloc[k], full_radius) for k in at]
            continue
        names = np.stack([np.asarray(nodes.iloc[k], np.int64) for k in at])
        bits = np.stack([np.asarray(fs.iloc[k], np.int64) for k in at]).view(np.uint64).reshape(len(at), size, -1)
        i, j = np.triu_indices(size, 1)
        step = max(1, 100_000 // len(i))
        for k in range(0, len(at), step):
            part = bits[k : k + step]
            near = np.bitwise_count(part[:, i] ^ part[:, j]).sum(axis=2, dtype=np.int64) <= full_radius
            tile, pair = np.nonzero(near)
            found.append(np.stack([names[k + tile, i[pair]], names[k + tile, j[pair]]], axis=1))
    edges = np.concatenate(found)
    return spanning(edges[:, 0], edges[:, 1])


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    parts: int = 4,
    words: int = 1,
    full_radius: int | None = None,
    distinct: bool = False,
) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of `docs` (doc_id, text).

    fingerprint is in hexadecimal digits, its first word first; component_id is the smallest doc_id
    that links of fingerprints reach, the row's own included. Rows of equal fingerprints are put together before
    anything is compared, so many copies of a text cost what one does. A text without words (null, empty, blank) has
    fingerprint zero and links as any other. A null doc_id is kept and gets the smallest doc_id of its group, or
    null if the group has none. Rows that share a doc_id keep their own fingerprints and rows.
    """
    prints = staged(
        fingerprints(docs, shingle, words, distinct).select(
            "doc_id", "f", (F.get("f", F.lit(0)) if words == 1 else F.xxhash64("f")).alias("node")
        ),
        "fingerprints",
    )
    classes = staged(prints.groupBy("node").agg(F.first("f").alias("f"), F.min("doc_id").alias("least")), "classes")
    named = _named(classes, components(links(classes, radius, parts, full_radius)))
    text = F.array_join(F.transform("f", lambda x: F.lpad(F.lower(F.hex(x)), 16, "0")), "")
    return prints.join(named, "node").select("doc_id", text.alias("fingerprint"), "component_id")


def _named(classes: DataFrame, reached: DataFrame) -> DataFrame:
    """(node, component_id) of all `classes` (node, least), with the components `reached` (node, component)."""
    classes = classes.select("node", "least").join(reached, "node", "left")
    classes = classes.select("node", "least", F.coalesce("component", "node").alias("component"))
    groups = classes.groupBy("component").agg(F.min("least").alias("component_id"))
    return classes.join(groups, "component").select("node", "component_id")


def _shared(x: list[np.ndarray], y: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many hashes the sets x[i] and y[j] share, for each pair."""
    if len(i) < BLOCK_ROWS:
        return np.array([len(np.intersect1d(x[a], y[b], assume_unique=True)) for a, b in zip(i, j, strict=True)], np.int64)
    (own, i), (other, j) = np.unique(i, return_inverse=True), np.unique(j, return_inverse=True)
    sets = [x[k] for k in own] + [y[k] for k in other]
    rows = np.repeat(np.arange(len(sets)), [len(h) for h in sets])
    names, places = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(places, kind="stable")
    rows, places = rows[order], places[order]
    counts = np.zeros((len(own), len(other)), np.float32)
    for at in range(0, len(names), BLOCK_HASHES):
        low, high = np.searchsorted(places, (at, at + BLOCK_HASHES))
        marks = np.zeros((len(sets), BLOCK_HASHES), np.float32)
        marks[rows[low:high], places[low:high] - at] = 1
        counts += marks[: len(own)] @ marks[len(own) :].T
    return counts[i, j].astype(np.int64)


def _set_tile(own: tuple, other: tuple | None, full_radius: int, similarity: float) -> np.ndarray:
    """Edges (node, node) that connect the similar sets of two tiles, or of one; a tile has nodes, fs, sizes, hashes."""

    def read(nodes, fs, sizes, hashes):
        sizes = np.asarray(sizes, np.int64)
        sets = np.split(np.asarray(hashes, np.int64), np.cumsum(sizes)[:-1])
        return np.asarray(nodes, np.int64), np.asarray(fs, np.int64).view(np.uint64).reshape(len(sizes), -1), sizes, sets

    n1, f1, s1, x = read(*own)
    n2, f2, s2, y = (n1, f1, s1, x) if other is None else read(*other)
    found = [np.empty((0, 2), np.int64)]
    for at in range(0, len(n1), BLOCK_ROWS):
        for to in range(at if other is None else 0, len(n2), BLOCK_ROWS):
            a, b = slice(at, at + BLOCK_ROWS), slice(to, to + BLOCK_ROWS)
            near = np.bitwise_count(f1[a, None] ^ f2[None, b]).sum(axis=2, dtype=np.int64) <= full_radius
            near &= np.minimum(s1[a, None], s2[None, b]) / np.maximum(s1[a, None], s2[None, b]) >= similarity
            near &= n1[a, None] != n2[None, b]
            i, j = np.nonzero(near)
            if len(i):
                shared = _shared(x[a], y[b], i, j)
                alike = shared / (s1[a][i] + s2[b][j] - shared) >= similarity
                found.append(spanning(n1[a][i[alike]], n2[b][j[alike]]))
    edges = np.concatenate(found)
    return spanning(edges[:, 0], edges[:, 1])


def set_links(families: DataFrame, full_radius: int, similarity: float) -> DataFrame:
    """Pairs (a, b) that connect all nodes of `families` (node, family, f, size, hashes) with similar sets in one family.

    Sets are similar if shared / all hashes (Jaccard) is at least `similarity`; pairs of fingerprints that differ in more than
    `full_radius` bits are not looked at. A family is cut by hash into tiles of about SET_ROWS rows and SET_HASHES hashes,
    and each tile compared with itself and with the later ones. A tile pair gives a spanning forest of its similar pairs.
    """
    cuts = families.groupBy("family").agg(
        F.ceil(F.greatest(F.count("*") / SET_ROWS, F.sum("size") / SET_HASHES)).cast("int").alias("cuts")
    )
    tiles = staged(
        families.join(cuts, "family")
        .withColumn("cut", F.pmod(F.xxhash64("node"), F.col("cuts")).cast("int"))
        .groupBy("family", "cut", "cuts")
        .agg(
            F.collect_list("node").alias("nodes"),
            F.flatten(F.collect_list("f")).alias("fs"),
            F.collect_list("size").alias("sizes"),
            F.flatten(F.collect_list("hashes")).alias("hashes"),
        ),
        "set-tiles",
    )
    fields = ["nodes", "fs", "sizes", "hashes"]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False, name=None):
                found = _set_tile(row[:4], row[4:] or None, full_radius, similarity)
                if len(found):
                    yield pd.DataFrame(found, columns=["a", "b"])

    # The pairs are made from the keys and get their tiles by key, so those of a large family are dealt like the rest.
    keys = tiles.where("cut + 1 < cuts").select("family", "cut", F.explode(F.sequence(F.col("cut") + 1, F.col("cuts") - 1)).alias("cut2"))
    second = tiles.select("family", F.col("cut").alias("cut2"), *[F.col(f).alias(f"{f}2") for f in fields])
    pairs = keys.join(tiles.drop("cuts"), ["family", "cut"]).join(second, ["family", "cut2"])
    pairs = pairs.select(*fields, *[f"{f}2" for f in fields])
    schema = "a long, b long"
    return tiles.select(fields).mapInPandas(compare, schema).unionByName(pairs.mapInPandas(compare, schema))


def similar_documents(docs: DataFrame, similarity: float, shingle: int, words: int, full_radius: int) -> DataFrame:
    """(doc_id, component_id) of every row of `docs` (doc_id, text): the smallest doc_id that links reach.

    Rows link if the sets of their shingles have a Jaccard similarity of at least `similarity`, counted exactly. Fingerprints
    (`full_radius` on all words) only choose what is counted, so they can miss a pair but never link one; the radius has to leave
    room for the spread of the bits. Fingerprints are compared where sets share one of their `set_keys`, which no similar pair
    is without. What the fingerprints connect is a family; the texts of families are read again for their sets, of all
    others only fingerprints and keys leave their task. Rows of equal sets are put together first. Texts
    without words (null, empty, blank) have the empty set and link with each other only. Null and shared doc_ids are treated as
    by near_duplicates.
    """
    rows = pick(docs, doc_id="doc_id", text="text").withColumn("mark", F.xxhash64("text"))

    @pandas_udf("node long, size int, f array<long>, keys array<long>")
    def printed(texts: pd.Series) -> pd.DataFrame:
        out = []
        for text in texts:
            h = np.unique(shingle_hashes(text, shingle))
            f = [_signed(majority(_mixed(h, k) if k else h)) for k in range(words)]
            out.append((_signed(xxhash.xxh64_intdigest(h.tobytes(), SEED)), len(h), f, set_keys(h, similarity).view(np.int64)))
        return pd.DataFrame(out, columns=["node", "size", "f", "keys"])

    @pandas_udf("array<long>")
    def hashes(texts: pd.Series) -> pd.Series:
        return pd.Series([np.unique(shingle_hashes(text, shingle)).view(np.int64) for text in texts], dtype=object)

    prints = staged(rows.select("doc_id", "mark", printed("text").alias("s")), "sets").select("doc_id", "mark", "s.*")
    classes = staged(
        prints.groupBy("node").agg(
            F.first("f").alias("f"),
            F.first("size").alias("size"),
            F.min("doc_id").alias("least"),
            F.min(F.struct("doc_id", "mark")).alias("chosen"),
        ),
        "classes",
    )
    keys = prints.where("size > 0").select("node", F.explode("keys").alias("key"))
    bits = components(keyed_links(classes.select("node", "f"), keys, full_radius))
    members = classes.join(bits, "node").select("node", "size", "f", "chosen", F.col("component").alias("family"))
    same = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("mark") == F.col("chosen.mark"))
    texts = members.join(rows, same).select("node", "size", "f", "family", "text").dropDuplicates(["node"])
    families = staged(texts.select("node", "size", "f", "family", hashes("text").alias("hashes")), "families")
    reached = components(set_links(families, full_radius, similarity))
    return prints.select("doc_id", "node").join(_named(classes, reached), "node").select("doc_id", "component_id")
