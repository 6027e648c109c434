"""Mixing sources to target weights: blocks of sources in the windows of a fair (Pfair) schedule, earliest deadline first. Frames of
the schedule take whole blocks by exact weights or by given whole parts."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import find, pick, staged
from hourloom.session import shuffle_partitions

BLOCK_ROWS = 4
FRAME_BLOCKS = 100  # slots of a frame, about; the SQL of op5 rounds weights to whole parts of as many
RUN_BLOCKS = 1024  # blocks made by one row
BUCKET_ROWS, RUN_BUCKETS, MAX_SOURCES = 512, 1024, 2_000
SPREAD = 2_654_435_761  # odd, so that spread() has no repeats among ids below 2**31


def spread(doc_id: Column) -> Column:
    """A number from 0 to 2**31 - 1 that scatters consecutive ids; 0 for a null."""
    low = F.pmod(F.coalesce(doc_id, F.lit(0)).cast("long"), F.lit(1 << 31))
    return F.pmod(low * F.lit(SPREAD), F.lit(1 << 31))


def _starts(sizes: DataFrame) -> DataFrame:
    """(g, bucket, start): what stands before each bucket of `sizes` (g, bucket, size), summed in two levels."""
    sizes = sizes.withColumn("run", F.floor(F.col("bucket") / RUN_BUCKETS))
    inside = Window.partitionBy("g", "run").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("before", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    runs = sizes.groupBy("g", "run").agg(F.sum("size").alias("size"))
    across = Window.partitionBy("g").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select("g", "run", F.coalesce(F.sum("size").over(across), F.lit(0)).alias("runs_before"))
    return sizes.join(runs, ["g", "run"]).select("g", "bucket", (F.col("before") + F.col("runs_before")).alias("start"))


def numbered(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """`rows` (g, u, ...) with `index`, from 0 in each g, by u and then by the other columns of `order`.

    `groups` has g and its row count n. A group is cut by ranges of u into buckets of about 512 rows,
    numbered inside; what stands before a bucket is summed in two levels. So the largest group
    is spread like the rest.
    """
    cut = F.floor(F.col("u") * F.ceil(F.col("n") / BUCKET_ROWS) / (1 << 31)).cast("long")
    cut_rows = rows.join(groups.select("g", "n"), "g").withColumn("bucket", cut).drop("n")
    starts = _starts(cut_rows.groupBy("g", "bucket").agg(F.count("*").alias("size")))
    place = F.row_number().over(Window.partitionBy("g", "bucket").orderBy("u", "tie"))
    return (
        cut_rows.withColumn("place", place)
        .join(starts, ["g", "bucket"])
        .withColumn("index", F.col("start") + F.col("place") - 1)
        .drop("bucket", "place", "start")
    )


def _by_weight(blocks: DataFrame, ends: DataFrame, top: float, dense: float) -> DataFrame:
    """(g, block, rank, ended) of `blocks` (g, block, v): the block's rank by v and g, from 0, and how many of `ends` (v) are not
    behind it.

    v is up to `top`. The axis of v is cut into buckets that would hold about 512 blocks each if the density of
    its start, `dense` blocks in all, held to the end. Both numbers are summed as one, the ends in the bits from 40 on.
    """
    cuts = max(1, -int(-dense // BUCKET_ROWS))
    marks = ends.select(F.lit(None).cast("string").alias("g"), F.lit(-1).cast("long").alias("block"), "v")
    one = F.when(F.col("block") < 0, F.lit(1 << 40)).otherwise(F.lit(1).cast("long"))
    cut = blocks.select("g", F.col("block").cast("long").alias("block"), "v").unionByName(marks).withColumns(
        {"bucket": F.floor(F.col("v") / F.lit(top) * F.lit(cuts)).cast("long"), "one": one}
    )
    sizes = cut.groupBy("bucket").agg(F.sum("one").alias("size"))
    starts = _starts(sizes.select(F.lit(0).alias("g"), "bucket", "size")).select("bucket", "start")
    before = Window.partitionBy("bucket").orderBy("v", F.col("block") >= 0, "g", "block").rowsBetween(Window.unboundedPreceding, -1)
    cut = cut.withColumn("before", F.coalesce(F.sum("one").over(before), F.lit(0))).where("block >= 0").join(starts, "bucket")
    both = F.col("start") + F.col("before")
    return cut.select("g", "block", F.pmod(both, F.lit(1 << 40)).alias("rank"), F.shiftright(both, 40).alias("ended"))


def frame_slots(sources: int) -> int:
    """Slots of a frame: about FRAME_BLOCKS, of which so many equal sources get whole parts."""
    return sources * max(1, int(FRAME_BLOCKS / sources + 0.5)) if 0 < sources <= FRAME_BLOCKS else FRAME_BLOCKS


def _fair(groups: DataFrame, block_rows: int) -> DataFrame:
    """(g, block, slot) of every block of `groups` (g, n, phase) by exact weights, the square roots of n.

    A frame's blocks are those of its ranks by (block + phase) / weight, so it takes of each source what is due to its exact weight,
    in whole blocks; a frame is cut where a source ends. In the frame they are released and due as frame_order() says, each
    frame by itself; a frame holds at most as many sources as slots, however many there are.
    """
    weight, blocks = F.sqrt("n"), F.ceil(F.col("n") / block_rows)
    total, top, sources = groups.agg(F.sum(weight), F.max(blocks / weight), F.count("*")).first()
    size = frame_slots(sources)
    run = F.explode(F.sequence(F.lit(0), F.floor((blocks - 1) / RUN_BLOCKS))).alias("run")
    runs = groups.select("g", "phase", weight.alias("w"), blocks.alias("b"), run)
    first = F.col("run") * RUN_BLOCKS
    made = runs.repartition(shuffle_partitions(groups.sparkSession), "g", "run").select(
        "g", "phase", "w", F.explode(F.sequence(first, F.least(first + RUN_BLOCKS, "b") - 1)).alias("block")
    )
    made = made.select("g", "block", ((F.col("block") + F.col("phase")) / F.col("w")).alias("v"))
    ends = groups.select((blocks / weight).alias("v"))
    ranked = _by_weight(made, ends, top or 1.0, (total or 0.0) * (top or 0.0))
    ranked = ranked.withColumn("frame", F.struct(F.floor(F.col("rank") / size).alias("no"), "ended"))
    taken = ranked.groupBy("frame", "g").agg(
        F.min("rank").alias("rank"), F.count("*").cast("int").alias("m"), F.min("block").alias("block")
    )
    frames = taken.groupBy("frame").agg(F.sort_array(F.collect_list(F.struct("rank", "g", "m", "block"))).alias("who"))
    order = frames.select("frame", "who", F.posexplode(frame_order(F.transform("who", lambda x: x["m"]))).alias("at", "x"))
    one = F.get("who", F.col("x.s"))
    return order.select(
        one["g"].alias("g"), (one["block"] + F.col("x.k")).alias("block"), (F.get("who", F.lit(0))["rank"] + F.col("at")).alias("slot")
    )


def frame_order(blocks: Column) -> Column:
    """Who has each slot of one frame: an array of (s, k), block k of source s, both from 0.

    `blocks` holds the blocks of each source in the frame; together they fill it. Of n blocks in a frame of
    m slots, block k is released at floor(k m / n) and due at ceil((k + 1) m / n): the window in which a fair
    machine would work on it. Each slot goes to the released block that is due first (ties: the lower
    source), which keeps every deadline, so that after any number of slots each source is less than one
    block away from its share.
    """
    total = F.aggregate(blocks, F.lit(0), lambda a, b: a + b)

    def slot(state: Column, t: Column) -> Column:
        def due(n: Column, s: Column) -> Column:
            k = F.get(state["next"], s)
            open_ = (k < n) & (F.floor(k * state["total"] / n) <= t)
            return F.when(open_, F.struct(F.ceil((k + 1) * state["total"] / n).alias("due"), s.alias("s"), k.alias("k")))

        def take(first: Column) -> Column:
            return F.struct(
                state["total"].alias("total"),
                F.transform(state["next"], lambda k, s: k + F.when(s == first["s"], 1).otherwise(0)).alias("next"),
                F.concat(state["order"], F.array(F.struct(first["s"].alias("s"), first["k"].alias("k")))).alias("order"),
            )

        # An array of one, so that the choice is made once and not for each use.
        return F.get(F.transform(F.array(F.array_min(F.transform(blocks, due))), take), 0)

    start = F.struct(
        total.alias("total"),
        F.transform(blocks, lambda n: n * 0).alias("next"),
        F.array().cast("array<struct<s:int,k:int>>").alias("order"),
    )
    slots = F.when(total > 0, F.sequence(F.lit(0), total - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(slots, start, slot, lambda state: state["order"])


def phases(counts: Mapping[str, int]) -> list[tuple[str, int, float]]:
    """(g, n, phase) of each source: evenly from 0 to 1 by name among sources of equal rows, which start at golden steps."""
    by_rows: dict[int, list[str]] = {}
    for g, n in counts.items():
        by_rows.setdefault(n, []).append(g)
    return [
        (g, n, (k * 0.6180339887498949 + (j + 0.5) / len(by_rows[n])) % 1)
        for k, n in enumerate(sorted(by_rows))
        for j, g in enumerate(sorted(by_rows[n]))
    ]


def frames(sizes: list[tuple[int, int]]) -> list[tuple]:
    """(first frame, frame after the last, first slot, slots a frame, blocks of each source) of each kind of frame.

    `sizes` has the blocks and the parts of each source. A frame takes its parts from every source that
    has them left; in the frame where a source ends it takes what is left of it. So frames
    change only where a source ends, at most twice for each source.
    """
    changes = sorted({0} | {b // p for b, p in sizes} | {-(-b // p) for b, p in sizes})
    out, slot = [], 0
    for first, after in zip(changes, changes[1:], strict=False):
        blocks = [max(0, min(p, b - first * p)) for b, p in sizes]
        out.append((first, after, slot, sum(blocks), blocks))
        slot += (after - first) * sum(blocks)
    return out


def schedule(docs: DataFrame, parts: Mapping | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Every row of `docs` (doc_id, source) with its place in the mixture: g, slot, place, row.

    row is a struct of all columns of `docs`. A source's rows, in scattered order of doc_id, form blocks of `block_rows` (the last
    may be shorter); slot is the block's place in the schedule and place the row's in the block. No row
    is dropped or repeated; a null source is a source of its own. Repeated rows get places of their own; an empty table gives
    an empty one.

    Without `parts` the weight w of a source is the square root of its rows, not rounded. The schedule is made of frames of about
    100 slots, cut where a source ends. Block k is at (k + phase) / w; the blocks of a frame are the next ones by that, so at its
    ends every source has had its exact share, less than one block more or less, and no error grows (the phases are spread evenly,
    so the errors of the sources nearly cancel). In the frame every block has its release and its deadline and each slot goes to
    the released block that is due first: another block away at most. Where a source ends, the others go on in their own
    proportion. Any number of sources: a table of up to 2,000 is broadcast, a larger one is joined and has its phases by hash.

    `parts` gives whole parts of the mixture to sources (others get 1). Then the schedule is made of frames with as many slots
    as there are parts: until a source ends, every source is less than one block away from its share after any number of
    slots; in its last frame a source is spread over the frame. The row counts of the sources reach the driver, so more than
    2,000 are a ValueError here.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names).select(F.struct(*names).alias("row"))
    doc_id = F.col(f"row.c{find(docs, 'doc_id')}")
    rows = rows.select(
        _group(F.col(f"row.c{find(docs, 'source')}")).alias("g"),
        spread(doc_id).alias("u"),
        F.struct(doc_id, F.xxhash64("row")).alias("tie"),
        "row",
    )
    keys = pick(docs, source="source")
    counted = keys.groupBy(_group(F.col("source")).alias("g")).agg(F.count("*").alias("n"), F.first("source").alias("source"))
    counts = [(r.g, r.n, r.source) for r in counted.limit(MAX_SOURCES + 1).collect()]
    few = len(counts) <= MAX_SOURCES
    if parts is not None:
        if not few:
            raise ValueError(f"parts for more than {MAX_SOURCES} sources")
        return _in_frames(rows, sorted(counts), parts, block_rows)
    if few:
        groups = docs.sparkSession.createDataFrame(phases({g: n for g, n, _ in counts}), "g string, n long, phase double")
        groups = F.broadcast(groups)
    else:
        phase = (F.pmod(F.xxhash64("g"), F.lit(1 << 20)) + 0.5) / (1 << 20)
        groups = staged(counted.select("g", "n", phase.alias("phase")), "sources")
    block = F.floor(F.col("index") / block_rows)
    placed = numbered(rows, groups).select(
        "g", block.alias("block"), F.pmod("index", F.lit(block_rows)).cast("long").alias("place"), "row"
    )
    return placed.join(_fair(groups, block_rows), ["g", "block"]).select("g", "slot", "place", "row")


def _in_frames(rows: DataFrame, counts: list[tuple], parts: Mapping, block_rows: int) -> DataFrame:
    """(g, slot, place, row) of `rows` (g, u, tie, row) by whole parts; `counts` has g, rows and name of the sources in order."""
    spark = rows.sparkSession
    chosen = {g: int(parts.get(source, 1)) for g, _, source in counts}
    if any(p < 1 for p in chosen.values()):
        raise ValueError("parts must be positive")
    kinds = frames([(-(-n // block_rows), chosen[g]) for g, n, _ in counts])
    order = (
        spark.createDataFrame(
            [(k, first, slot, size, blocks) for k, (first, _, slot, size, blocks) in enumerate(kinds)],
            "kind int, first long, slot long, size long, blocks array<int>",
        )
        .repartition(max(1, len(kinds)))
        .select("kind", "first", "slot", "size", F.posexplode(frame_order(F.col("blocks"))).alias("at", "who"))
        .select("kind", "first", "slot", "size", F.col("at").cast("long").alias("at"), F.col("who.s").alias("s"), F.col("who.k").alias("k"))
    )
    groups = spark.createDataFrame(
        [(g, s, n, chosen[g]) for s, (g, n, _) in enumerate(counts)], "g string, s int, n long, p long"
    )
    block = F.floor(F.col("index") / block_rows)
    firsts = F.array(*[F.lit(first).cast("long") for first, *_ in kinds]) if kinds else F.array().cast("array<long>")
    placed = (
        numbered(rows, F.broadcast(groups))
        .join(F.broadcast(groups.select("g", "s", "p")), "g")
        .withColumn("block", block)
        .withColumn("frame", F.floor(F.col("block") / F.col("p")))
        .withColumn("k", F.pmod("block", "p").cast("int"))
        .withColumn("kind", F.size(F.filter(firsts, lambda x: x <= F.col("frame"))) - 1)
    )
    return placed.join(order, ["kind", "s", "k"]).select(
        "g",
        (F.col("slot") + (F.col("frame") - F.col("first")) * F.col("size") + F.col("at")).alias("slot"),
        F.pmod("index", F.lit(block_rows)).cast("long").alias("place"),
        "row",
    )


def _group(source: Column) -> Column:
    """A key that is never null: the source behind an equals sign, or nothing for a null source."""
    return F.coalesce(F.concat(F.lit("="), source.cast("string")), F.lit(""))


def mixed(docs: DataFrame, parts: Mapping | None = None, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The rows and columns of `docs` in the order of the mixture, by ranges of it over the partitions."""
    done = schedule(docs, parts, block_rows).orderBy("slot", "place")
    names = [f"c{k}" for k in range(len(docs.columns))]
    return done.select(*[F.col(f"row.{n}") for n in names]).toDF(*docs.columns)
