"""Connected components of an edge table by repeated star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import staged


def _pairs(df: DataFrame) -> DataFrame:
    return df.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node of `edges` (a, b); component is the smallest node reachable.

    Each round first hangs every larger neighbour of a node on the node's smallest neighbour, then every
    smaller one; it ends when a round changes nothing, after about log(longest path) rounds. A round is
    two aggregations and two joins, each by node, written to the shared folder: nothing of the graph
    reaches the driver, and a lost executor costs the running round at most. Nulls and loops count
    as no edge, and an empty table gives an empty one.
    """
    now = staged(_pairs(edges.select("a", "b").dropna()), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = _pairs(both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")))
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        small = _pairs(joined.select("b", "m").toDF("a", "b").unionByName(joined.select("a", "m").toDF("a", "b")))
        after = staged(small, "edges")
        marks = [
            df.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first() for df in (now, after)
        ]
        now = after
        if marks[0] == marks[1]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("component")).unionByName(
                now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
            )
