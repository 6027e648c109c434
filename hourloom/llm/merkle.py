"""Merkle manifest of a corpus: levels of parent-linked node rows, and proofs by a recursive query that climbs them."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, pick, staged
from hourloom.session import work_path

FANOUT = 8
TOP = -1  # the tree over the subroots
RUN = "tree long, level int, idx long, line string, h string, n long"

# One row for each run of leaves: all of its leaves climb together, since what lies above them is the same. A step joins
# the run that holds the node reached, puts every leaf's own digest in the node's place and appends the node's siblings.
CLIMB = """
with recursive climb (tree, up_tree, up_level, up_idx, pos, members, above) as (
    select tree, up_tree, up_level, up_idx, pos, members, cast('' as binary) from {start}
    union all
    select tree, up_tree, up_level, up_idx, pos,
        transform(members, m -> named_struct('doc_id', m.doc_id, 'leaf', m.leaf,
            'folded', unhex(sha2(concat(left_of, lower(hex(m.folded)), right_of), 256)))),
        concat(above, unhex(left_of), unhex(right_of))
    from (
        select c.tree, r.up_tree, r.up_level, r.up_idx, r.pos, c.members, c.above,
            substring(r.line, 1, 64 * c.pos) as left_of, substring(r.line, 64 * c.pos + 65) as right_of
        from climb c join {runs} r on r.tree = c.up_tree and r.level = c.up_level and r.idx = c.up_idx
    )
)
select tree, members, above from climb where up_tree is null
"""


@dataclass(frozen=True)
class Manifest:
    """leaves (tree, idx, doc_id, leaf, tampered, n), runs (tree, level, idx, line, h, up_tree, up_level, up_idx, pos), subroots
    (tree, subroot) and the root, which is null for an empty table."""

    leaves: DataFrame
    runs: DataFrame
    subroots: DataFrame
    root: str | None


def digest(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf(doc_id: Column, source: Column, lang: Column, n_chars: Column, text: Column) -> Column:
    """The digest of a row: each value as `-` if null, else its UTF-8 bytes' number, a colon and the value."""

    def field(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(field, (doc_id, source, lang, n_chars, text)))


def placed(rows: DataFrame, group: list[str], order: list[str], name: str) -> DataFrame:
    """`rows` with `idx`, their place from 0 within `group` by `order`, nulls first.

    Rows are sorted once over the whole table, so that a group is spread over as many tasks as it needs; each task's stretch
    of a group starts behind the group's rows in earlier tasks, whose numbers are one row for each task and group.
    """
    keys = [F.col(c).asc_nulls_first() for c in [*group, *order]]
    seen = rows.withColumn("seen", F.monotonically_increasing_id())  # equal rows can be told apart and so be spread
    sorted_rows = staged(seen.orderBy(*keys, "seen").drop("seen").withColumn("at", F.monotonically_increasing_id()), name)
    stretches = sorted_rows.groupBy(*group, F.shiftright("at", 33).alias("part")).agg(
        F.min("at").alias("first"), F.count("*").alias("rows")
    )
    earlier = Window.partitionBy(*group).orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = stretches.withColumn("before", F.coalesce(F.sum("rows").over(earlier), F.lit(0)))
    offsets = offsets.select(*[F.col(g).alias(f"_{g}") for g in group], "part", "first", "before")
    same = [F.col(g).eqNullSafe(F.col(f"_{g}")) for g in group] + [F.shiftright("at", 33) == F.col("part")]
    joined = sorted_rows.join(offsets, reduce(lambda a, b: a & b, same))
    return joined.select(*rows.columns, (F.col("at") - F.col("first") + F.col("before")).alias("idx"))


def _rise(nodes: DataFrame, folder: str, largest: int) -> list[str]:
    """Write the runs above `nodes` (tree, idx, h, n) level by level until each tree has one node; the paths.

    n is the number of nodes that the tree has on the level. A level is one aggregation of at most eight rows a group.
    """
    spark, paths = nodes.sparkSession, []
    while largest > 1:
        level = len(paths) + 1
        inside = nodes.where("n > 1").groupBy("tree", F.floor(F.col("idx") / FANOUT).alias("up"))
        lines = inside.agg(F.sort_array(F.collect_list(F.struct("idx", "h"))).alias("nodes"), F.first("n").alias("n"))
        line = F.array_join(F.col("nodes")["h"], "")
        n = F.ceil(F.col("n") / FANOUT)
        runs = lines.select("tree", F.lit(level).alias("level"), F.col("up").alias("idx"), line.alias("line"), n.alias("n"))
        paths.append(f"{folder}/level={level}")
        runs.withColumn("h", digest(F.col("line"))).write.parquet(paths[-1])
        nodes = spark.read.schema(RUN).option("basePath", paths[-1]).parquet(paths[-1])
        largest = -(-largest // FANOUT)
    return paths


def _linked(nodes: DataFrame, level: Column, trees: int) -> DataFrame:
    """`nodes` with the run that holds them and their place in it: in their tree, else over the subroots, else nulls."""
    inside, above = F.col("n") > 1, (F.col("tree") != TOP) & F.lit(trees > 1)

    def either(within: Column, over: Column) -> Column:
        return F.when(inside, within).when(above, over)

    return nodes.withColumns(
        {
            "up_tree": either(F.col("tree"), F.lit(TOP).cast("long")),
            "up_level": either(level + 1, F.lit(1)),
            "up_idx": either(F.floor(F.col("idx") / FANOUT), F.floor(F.col("tree") / FANOUT)),
            "pos": either(F.pmod("idx", F.lit(FANOUT)), F.pmod("tree", F.lit(FANOUT))).cast("int"),
        }
    )


def build(docs: DataFrame, tampered_text=None, folder: str | None = None) -> Manifest:
    """The manifest of `docs` (doc_id, source, lang, n_chars, text), its runs written under `folder`.

    Every row is a leaf of its lang's tree, by doc_id, nulls first, rows of one doc_id by leaf; trees are numbered from 0 by
    lang, null first. `tampered_text(doc_id, text)` gives the text of the column tampered, by default the text itself.
    """
    rows = pick(docs, doc_id="doc_id", source="source", lang="lang", n_chars="n_chars", text="text")
    spark, folder = docs.sparkSession, folder or work_path(docs.sparkSession, "manifest")
    others = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    own = leaf(*others, F.col("text"))
    other = leaf(*others, tampered_text(F.col("doc_id"), F.col("text"))) if tampered_text else own
    hashed = rows.select("doc_id", "lang", own.alias("leaf"), other.alias("tampered"))
    in_order = placed(hashed, ["lang"], ["doc_id", "leaf"], "leaves")
    sizes = in_order.groupBy("lang").agg(F.count("*").alias("n"))
    langs = staged(placed(sizes, [], ["lang"], "langs").withColumnRenamed("idx", "tree"), "trees")
    trees, largest = langs.agg(F.count("*"), F.max("n")).first()
    same = F.col("lang").eqNullSafe(F.col("_lang"))
    numbers = langs.select(F.col("lang").alias("_lang"), "tree", "n")
    leaves = staged(in_order.join(numbers, same).drop("lang", "_lang"), "leaves")

    levels = _rise(leaves.select("tree", "idx", F.col("leaf").alias("h"), "n"), f"{folder}/trees", largest or 0)
    lone = leaves.where("n = 1").select("tree", F.col("leaf").alias("subroot"))
    tops = _read(spark, levels).where("n = 1").select("tree", F.col("h").alias("subroot"))
    subroots = staged(lone.unionByName(tops), "subroots")
    over = subroots.select(
        F.lit(TOP).cast("long").alias("tree"), F.col("tree").alias("idx"), F.col("subroot").alias("h"), F.lit(trees).cast("long").alias("n")
    )
    top_levels = _rise(over, f"{folder}/top", trees)
    last = spark.read.schema(RUN).parquet(top_levels[-1]).select("h") if top_levels else subroots.select("subroot")
    found = last.first()
    runs = _linked(_read(spark, levels + top_levels), F.col("level"), trees).drop("n")
    return Manifest(_linked(leaves, F.lit(0), trees), runs, subroots, found[0] if found else None)


def _read(spark: SparkSession, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], RUN)
    parts = [spark.read.schema(RUN).option("basePath", p).parquet(p) for p in paths]
    return reduce(DataFrame.unionByName, parts)


@contextmanager
def _whole_recursion(spark: SparkSession):
    """Spark ends recursive queries beyond a number of rows; a manifest has as many as it has leaves."""
    key = "spark.sql.cteRecursionRowLimit"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "-1")
    try:
        yield
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)


def prove(manifest: Manifest) -> DataFrame:
    """(tree, doc_id, leaf, folded_root, siblings) of every leaf.

    folded_root folds the leaf's column tampered with the stored siblings up to the root; siblings is their hex text, level by level,
    left to right. Spark runs the climb as one recursive query, a join of all leaves' runs with the stored runs for
    each level, whose rows go through shuffle files; digests travel as bytes.
    """
    spark = manifest.runs.sparkSession
    run = ["tree", "up_tree", "up_level", "up_idx"]
    by_place = F.sort_array(F.collect_list(F.struct("idx", "doc_id", "leaf", "tampered")))
    first = manifest.leaves.groupBy(*run, F.when(F.col("n") == 1, F.col("pos")).alias("pos")).agg(by_place.alias("own"), F.first("n").alias("n"))
    line = F.array_join(F.col("own")["leaf"], "")

    def member(m: Column, k: Column) -> Column:
        inside = digest(F.substr("line", F.lit(1), 64 * k), m["tampered"], F.substr("line", 64 * k + 65))
        folded = F.when(F.col("n") > 1, inside).otherwise(m["tampered"])
        return F.struct(m["doc_id"].alias("doc_id"), F.unhex(m["leaf"]).alias("leaf"), F.unhex(folded).alias("folded"))

    # The run of a leaf is climbed by the leaves it was made of: the next one is the run that holds this run.
    holds = manifest.runs.where(F.col("level") == 1).select(
        F.col("tree").alias("up_tree"), F.col("level").alias("up_level"), F.col("idx").alias("up_idx"),
        *[F.col(c).alias(f"next_{c}") for c in ("up_tree", "up_level", "up_idx", "pos")],
    )
    joined = first.withColumn("line", line).join(holds, ["up_tree", "up_level", "up_idx"], "left")

    def after(name: str) -> Column:
        return F.when(F.col("n") > 1, F.col(f"next_{name}")).otherwise(F.col(name)).alias(name)

    start = joined.select(
        "tree", after("up_tree"), after("up_level"), after("up_idx"), after("pos"), F.transform("own", member).alias("members")
    )
    with _whole_recursion(spark):
        climbed = staged(spark.sql(CLIMB, start=staged(start, "start"), runs=manifest.runs), "climbed")
    leaves = F.lower(F.array_join(F.transform("members", lambda m: F.hex(m["leaf"])), ""))
    each = climbed.select("tree", F.lower(F.hex("above")).alias("above"), leaves.alias("line"), F.posexplode("members").alias("k", "m"))
    siblings = F.concat(F.substr("line", F.lit(1), 64 * F.col("k")), F.substr("line", 64 * F.col("k") + 65), "above")
    return each.select(
        "tree",
        F.col("m.doc_id").alias("doc_id"),
        F.lower(F.hex("m.leaf")).alias("leaf"),
        F.lower(F.hex("m.folded")).alias("folded_root"),
        siblings.alias("siblings"),
    )


def third_lowered(doc_id: Column, text: Column) -> Column:
    """A-Z lower-cased where 3 divides the CRC-32 of the decimal doc_id; a null doc_id is left alone."""
    hit = F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 0, F.lit(False))
    return F.when(hit, ascii_lower(text)).otherwise(text)


def verify(docs: DataFrame, tampered_text=third_lowered) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row of `docs`.

    A null in any column is a value of its own; rows without a lang form the first tree, rows without a doc_id come first in theirs.
    Repeated rows are leaves of their own, in any order, since their digests are equal. An empty text has a digest other than a null.
    Other columns, whatever their names, are left out of the leaf. An empty table gives an empty one.
    """
    manifest = build(docs, tampered_text)
    proofs = prove(manifest).join(manifest.subroots, "tree")
    root = F.lit(manifest.root)
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        root.alias("root"),
        digest(F.col("siblings")).alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == root).alias("verified"),
    )
