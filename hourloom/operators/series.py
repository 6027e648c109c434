"""Regular grids, de-duplication, priority union and the raw-to-warehouse step."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.consts import HOUR
from hourloom.functions.time import epoch_seconds, ntz, steps_between, to_utc
from hourloom.functions.values import strict_numeric
from hourloom.session import shuffle_partitions

#: Steps generated by one input row of the second grid level.
GRID_BLOCK = 1024


def time_bounds(df: DataFrame) -> DataFrame:
    """First and last ts and the row count of each series."""
    return df.groupBy("series_id").agg(
        F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count("*").alias("n_rows")
    )


def make_grid(bounds: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Every step from start_ts to end_ts, both ends included.

    Two levels: blocks of GRID_BLOCK steps are spread over the cluster first, so
    one long series is not generated by a single task from a single huge array.
    """
    blocks = bounds.select(
        "series_id",
        "start_ts",
        steps_between("start_ts", "end_ts", step).alias("_last"),
    ).withColumn("_block", F.explode(F.sequence(F.lit(0), F.floor(F.col("_last") / GRID_BLOCK))))
    spread = blocks.repartition(
        shuffle_partitions(bounds.sparkSession), "series_id", "_block"
    )
    first = F.col("_block") * GRID_BLOCK
    return spread.select(
        "series_id",
        "start_ts",
        F.explode(F.sequence(first, F.least(first + GRID_BLOCK - 1, "_last"))).alias("_k"),
    ).select("series_id", (F.col("start_ts") + F.lit(step) * F.col("_k")).alias("ts"))


def fill_grid(df: DataFrame, step: timedelta = HOUR, bounds: DataFrame | None = None) -> DataFrame:
    """Every step of each series, with nulls where `df` has no row.

    The grid spans the data unless `bounds` (series_id, start_ts, end_ts) says otherwise.
    The data are of the grid's own order of size, so they are sort-merged, which can
    spill, and never broadcast.
    """
    grid = make_grid(time_bounds(df) if bounds is None else bounds, step)
    return grid.join(df.hint("merge"), ["series_id", "ts"], "left").select(*df.columns)


def dedupe_first(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """Keep, per key, the row with the lowest `priority`, which is then dropped.

    An aggregation: copies collapse before the shuffle. A distributed frame has no
    row order, so the order must come as a column that is unique within a key.
    """
    payload = [c for c in df.columns if c not in keys and c != priority]
    if not payload:
        return df.select(*keys).distinct()
    if len(payload) == 1:
        # A single primitive column keeps the aggregation hash-based.
        return df.groupBy(*keys).agg(F.min_by(payload[0], priority).alias(payload[0]))
    kept = df.groupBy(*keys).agg(F.min_by(F.struct(*payload), priority).alias("_row"))
    return kept.select(*keys, "_row.*")


def drop_duplicates(df: DataFrame, keys: Sequence[str], priority: str) -> DataFrame:
    """One row per key: the first by `priority`, all columns kept."""
    return dedupe_first(df.withColumn("_priority", F.col(priority)), keys, "_priority").select(
        *df.columns
    )


def concat_series(dfs: Sequence[DataFrame], fill_stored_nulls: bool = False) -> DataFrame:
    """Union of series frames; where a (series_id, ts) repeats the earliest frame wins.

    The winner may carry a null, as stored rows do; with `fill_stored_nulls` a later
    frame's value is preferred to a null.
    """
    ranked = [df.withColumn("_rank", F.lit(i)) for i, df in enumerate(dfs)]
    rows = reduce(lambda a, b: a.unionByName(b), ranked)
    if fill_stored_nulls:
        rows = rows.withColumn("_rank", F.col("_rank") + F.when(F.col("d").isNull(), len(dfs)).otherwise(0))
    return dedupe_first(rows, ["series_id", "ts"], "_rank").select(*dfs[0].columns)


def concat(dfs: Sequence[DataFrame]) -> DataFrame:
    """Bag union by column name."""
    return reduce(lambda a, b: a.unionByName(b), dfs)


def sort_series(df: DataFrame) -> DataFrame:
    """Total order by series and time; range-partitioned, for output only."""
    return df.orderBy("series_id", "ts")


def time_range(df: DataFrame, start: datetime, end: datetime) -> DataFrame:
    """Rows with start <= ts <= end."""
    return df.filter(F.col("ts").between(ntz(start), ntz(end)))


def strip_history(df: DataFrame, start: datetime) -> DataFrame:
    """Rows from `start` on."""
    return df.filter(F.col("ts") >= ntz(start))


def first_last(df: DataFrame) -> DataFrame:
    """First and last row of each series."""
    return df.groupBy("series_id").agg(
        F.min("ts").alias("first_ts"),
        F.min_by("d", "ts").alias("first_d"),
        F.max("ts").alias("last_ts"),
        F.max_by("d", "ts").alias("last_d"),
    )


def full_index_check(df: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Per series: does it hold every step from its first to its last ts exactly once?"""
    seconds = int(step.total_seconds())
    moments = df.groupBy("series_id", "ts").agg(F.count("*").alias("_copies"))
    found = moments.groupBy("series_id").agg(
        F.sum("_copies").alias("n_rows"),
        F.count("*").alias("n_distinct"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        # All rows on the grid of the first one <=> all have the same remainder.
        F.min(F.pmod(epoch_seconds("ts"), F.lit(seconds))).alias("_low"),
        F.max(F.pmod(epoch_seconds("ts"), F.lit(seconds))).alias("_high"),
        F.count_if(F.extract(F.lit("SECOND"), "ts") != F.second("ts")).alias("_fractions"),
    )
    expected = steps_between("start_ts", "end_ts", step) + 1
    return found.select(
        "series_id",
        "start_ts",
        "end_ts",
        "n_rows",
        expected.alias("n_expected"),
        (
            (F.col("n_rows") == F.col("n_distinct"))
            & (F.col("n_distinct") == expected)
            & (F.col("_low") == F.col("_high"))
            & (F.col("_fractions") == 0)
        ).alias("full_index"),
    )


def facet(df: DataFrame, name: str) -> DataFrame:
    return df.filter(F.col("type") == name)


def typed_raw(raw: DataFrame) -> DataFrame:
    """Raw records (period, respondent, type, value, position) with timestamps and numbers."""
    return raw.select(
        F.col("respondent").alias("series_id"),
        to_utc("period").alias("ts"),
        "type",
        strict_numeric("value").alias("value"),
        "position",
    )


def typed_to_warehouse(
    typed: DataFrame, step: timedelta = HOUR, bounds: DataFrame | None = None
) -> DataFrame:
    demand = facet(typed, "D").select("series_id", "ts", F.col("value").alias("d"), "position")
    first = dedupe_first(demand, ["series_id", "ts"], "position")
    return fill_grid(first, step, time_bounds(typed) if bounds is None else bounds)


def to_warehouse(raw: DataFrame, step: timedelta = HOUR, bounds: DataFrame | None = None) -> DataFrame:
    """Raw records to (series_id, ts, d) on the full grid of the data's own bounds.

    The demand facet is chosen before de-duplication, so that a forecast row never
    hides a demand row of the same hour.
    """
    return typed_to_warehouse(typed_raw(raw), step, bounds)


def facets_wide(typed: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Demand and forecast side by side on the grid: one aggregation, one grid join."""

    def first_of(name: str):
        return F.min_by(
            F.when(F.col("type") == name, F.col("value")),
            F.when(F.col("type") == name, F.col("position")),
        )

    wide = typed.groupBy("series_id", "ts").agg(
        first_of("D").alias("d"), first_of("DF").alias("df")
    )
    return fill_grid(wide, step)
