"""The chunk store: Parquet rows by calendar quarter and series bucket, and a versioned chunk index.

``<store>/data/version=N/year=Y/quarter=Q/bucket=K/`` holds (series_id, ts, d) rows, the bucket being a hash of the
series, and ``<store>/index/version=N/`` one full chunk index per update, which names the data version of every part, that is
of every quarter and bucket. An update writes the parts that it changes under a new version and its index last: new rows of
one series rewrite its bucket in the quarters that they touch and nothing else. Readers follow the newest
finished index, so a writer that dies before that leaves the store as it was, and of two writers
that start from the same version one fails. Versions that no reader needs any more can be deleted.
"""

from __future__ import annotations

from collections.abc import Collection
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hourloom.consts import HOUR
from hourloom.operators.chunks import chunk_diff, chunk_index, hit_miss, update_chunk_index
from hourloom.operators.lookup import lookup
from hourloom.operators.quality import assert_full_index, validate, warehouse_suite
from hourloom.operators.series import (
    concat,
    concat_series,
    full_index_check,
    time_bounds,
    time_range,
    typed_raw,
    typed_to_warehouse,
)
from hourloom.functions.time import quantize_end, quantize_start, steps_between
from hourloom.schemas import CHUNK_INDEX, SERIES, STORED_SERIES, assert_schema
from hourloom.session import version_folders, work_path


class DataUnavailable(RuntimeError):
    """The raw source has nothing for a range that was asked of it."""


def staged(df: DataFrame, name: str) -> DataFrame:
    """Write `df` once to the shared work folder and read it back.

    For frames that several jobs use: the rows stay the same in all of them, and a
    lost executor costs one task, not the whole lineage.
    """
    spark = df.sparkSession
    path = work_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: Series buckets of a store whose writer names no other number; a store keeps the number that it was started with.
BUCKETS = 4
_PLACED_INDEX = T.StructType(
    CHUNK_INDEX.fields
    + [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("buckets", T.IntegerType()),
        T.StructField("data_version", T.LongType()),
    ]
)
_STORED = T.StructType(STORED_SERIES.fields + [T.StructField("bucket", T.IntegerType())])
#: (year, quarter, bucket) of a part.
Part = tuple[int, int, int]


def bucket_of(series_id: Column | str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(series_id), F.lit(buckets)).cast("int")


def _part_key(year: Column, quarter: Column, bucket: Column) -> Column:
    return (year.cast("long") * 10 + quarter) * 1_000_000 + bucket


def _key(part: Part) -> int:
    return (part[0] * 10 + part[1]) * 1_000_000 + part[2]


def _index_versions(spark: SparkSession, store: str) -> tuple[int, int]:
    """(newest finished, newest started) version of the chunk index by the names of its folders; 0 if there is none."""
    finished, others = version_folders(spark, f"{store}/index", "_SUCCESS")
    return max(finished, default=0), max([0, *finished, *others])


def _placed_index(spark: SparkSession, store: str) -> DataFrame:
    newest, _ = _index_versions(spark, store)
    if not newest:
        return spark.createDataFrame([], _PLACED_INDEX)
    return spark.read.schema(_PLACED_INDEX).parquet(f"{store}/index/version={newest}")


def _places(spark: SparkSession, store: str) -> tuple[dict[Part, int], int]:
    """The data version of each part, and the number of buckets: one entry per quarter and bucket, not per series."""
    rows = _placed_index(spark, store).where("data_version is not null")
    found = rows.select("year", "quarter", "bucket", "buckets", "data_version").distinct().collect()
    return {(r.year, r.quarter, r.bucket): r.data_version for r in found}, max((r.buckets for r in found), default=0)


def read_chunks(spark: SparkSession, store: str, parts: Collection[Part] | None = None) -> DataFrame:
    """All stored rows, or those of the given parts, with their partition columns."""
    places, _ = _places(spark, store)
    chosen = {p: v for p, v in places.items() if parts is None or p in parts}
    if not chosen:
        return spark.createDataFrame([], STORED_SERIES)
    folders = [f"{store}/data/version={v}" for v in sorted(set(chosen.values()))]
    schema = T.StructType(_STORED.fields + [T.StructField("version", T.LongType())])
    place = F.col("version") * 100_000_000_000 + _part_key(F.col("year"), F.col("quarter"), F.col("bucket"))
    current = place.isin(sorted(v * 100_000_000_000 + _key(p) for p, v in chosen.items()))
    rows = spark.read.schema(schema).option("basePath", f"{store}/data").parquet(*folders)
    return rows.filter(current).select(*[f.name for f in STORED_SERIES])


def current_parts(spark: SparkSession, store: str) -> dict[Part, int]:
    """The data version that readers use of each part."""
    return _places(spark, store)[0]


def data_of_version(spark: SparkSession, store: str, version: int) -> DataFrame:
    """All rows that one update wrote, with year, quarter and bucket."""
    return spark.read.schema(_STORED).parquet(f"{store}/data/version={version}")


def _quarter_no(ts: datetime) -> int:
    return ts.year * 10 + (ts.month + 2) // 3


def read_range(
    spark: SparkSession, store: str, start: datetime, end: datetime, parts: Collection[Part] | None = None
) -> DataFrame:
    """Stored rows with start <= ts <= end, opening only the quarters, and of them the parts, that can hold them."""
    quarter_no = F.col("year") * 10 + F.col("quarter")
    rows = read_chunks(spark, store, parts).filter(quarter_no.between(_quarter_no(start), _quarter_no(end)))
    return time_range(rows, start, end).select(*[f.name for f in SERIES])


def write_chunks(df: DataFrame, store: str, version: int, buckets: int = BUCKETS) -> None:
    """Write rows into their parts under a data version.

    The rebalance hint lets Spark cut a big part into many files and join small ones in a task, whatever the skew; rows are
    sorted by series inside, so that a filter on the series skips row groups.
    """
    part = {"year": F.year("ts"), "quarter": F.quarter("ts"), "bucket": bucket_of("series_id", buckets)}
    (
        df.withColumns(part)
        .hint("rebalance", *part)
        .sortWithinPartitions(*part, "series_id", "ts")
        .write.mode("overwrite")
        .partitionBy(*part)
        .parquet(f"{store}/data/version={version}")
    )


def read_chunk_index(spark: SparkSession, store: str) -> DataFrame:
    """The newest chunk index, checked against its schema."""
    return assert_schema(_placed_index(spark, store).drop("bucket", "buckets", "data_version"), CHUNK_INDEX)


def write_chunk_index(index: DataFrame, store: str, version: int, places: dict[Part, int], buckets: int) -> None:
    """Add a version of the chunk index, which must not exist yet, with the data version of each part."""
    spark = index.sparkSession
    rows = [(*part, v) for part, v in places.items()]
    placed = spark.createDataFrame(rows, "year int, quarter int, bucket int, data_version long")
    (
        assert_schema(index, CHUNK_INDEX)
        .withColumns({"bucket": bucket_of("series_id", buckets), "buckets": F.lit(buckets)})
        .join(placed, ["year", "quarter", "bucket"], "left")
        .select(*[f.name for f in _PLACED_INDEX])
        .write.mode("error")
        .parquet(f"{store}/index/version={version}")
    )


def _parts(chunks: DataFrame, buckets: int) -> list[Part]:
    """The parts that hold the given chunks (series_id, year, quarter); one row for each, however many series there are."""
    found = chunks.select("year", "quarter", bucket_of("series_id", buckets).alias("bucket")).distinct().collect()
    return [tuple(row) for row in found]


def write_store(df: DataFrame, store: str, step: timedelta = HOUR, buckets: int = BUCKETS) -> None:
    """Start a store from rows that are on the full grid."""
    spark = df.sparkSession
    version = _index_versions(spark, store)[1] + 1
    write_chunks(df, store, version, buckets)
    index = staged(chunk_index(time_bounds(data_of_version(spark, store, version)), step), "chunk-index")
    write_chunk_index(index, store, version, dict.fromkeys(_parts(index, buckets), version), buckets)


def upsert_chunks(
    df: DataFrame,
    store: str,
    step: timedelta = HOUR,
    fill_stored_nulls: bool = False,
    on_fail: str = "warn",
) -> DataFrame:
    """Merge new rows into the store and return the chunk diff that was applied.

    The rows must be on the full grid. A part, one quarter of one series bucket, is written when it is new or was
    partial for some of its series; stored rows win over new ones, also with a null value.
    """
    spark = df.sparkSession
    rows = staged(df.select(*[f.name for f in SERIES]), "upsert")
    checked = staged(full_index_check(rows, step), "index-check")
    assert_full_index(checked)
    validate(rows, "warehouse", warehouse_suite(step), on_fail)

    old = read_chunk_index(spark, store)
    bounds = checked.select("series_id", "start_ts", "end_ts")
    diff = staged(chunk_diff(old, chunk_index(bounds, step)), "chunk-diff")
    # Fails here, before anything is written, if the new rows leave a gap.
    updated = staged(update_chunk_index(old, bounds, step), "chunk-index")

    version, (places, buckets) = _index_versions(spark, store)[1] + 1, _places(spark, store)
    buckets = buckets or BUCKETS
    touched = _parts(diff, buckets)
    if touched:
        stored = read_chunks(spark, store, set(touched))
        key = _part_key(F.year("ts"), F.quarter("ts"), bucket_of("series_id", buckets))
        fresh = rows.filter(key.isin(sorted(map(_key, touched))))
        merged = concat_series([stored.select(*fresh.columns), fresh], fill_stored_nulls)
        write_chunks(merged, store, version, buckets)
        places |= dict.fromkeys(touched, version)
    write_chunk_index(updated, store, version, places, buckets)
    return diff


def fetch_raw(raw: DataFrame, ranges: DataFrame, step: timedelta = HOUR) -> DataFrame:
    """Typed raw demand records inside each series' (start_ts, end_ts), both ends included.

    The source is asked for facet D and whole days around all ranges, as filters on the raw text that reach
    the scan (ISO times sort as text; a day more on both sides leaves room for offsets), and
    the answer is trimmed back to each series' own range.
    """
    wanted = ranges.select(
        "series_id",
        F.col("start_ts").alias("_start"),
        F.col("end_ts").alias("_end"),
    )
    span = ranges.agg(
        F.min(quantize_start("start_ts")).alias("low"), F.max(quantize_end("end_ts")).alias("high")
    ).first()
    if span.low is None:
        asked = typed_raw(raw).filter(F.lit(False))
    else:
        first, after = span.low.date() - timedelta(days=1), span.high.date() + timedelta(days=2)
        text = raw.filter(
            (F.col("type") == "D") & (F.col("period") >= first.isoformat()) & (F.col("period") < after.isoformat())
        )
        asked = time_range(typed_raw(text), span.low, span.high)
    return (
        lookup(asked, wanted, ["series_id"], how="inner")
        .filter(F.col("ts").between(F.col("_start"), F.col("_end")))
        .drop("_start", "_end")
    )


def fetch_range(
    spark: SparkSession,
    store: str,
    raw: DataFrame,
    requests: DataFrame,
    step: timedelta = HOUR,
    use_store: bool = True,
    close_gap: bool = False,
    allow_missing: bool = False,
) -> DataFrame:
    """Rows of the requested (series_id, start_ts, end_ts) from the store and the raw source.

    One request per series. The stored part comes from the chunks, the rest from `raw` (transformed first);
    with ``use_store=False`` everything comes from `raw`. Stored rows win. Raises DataUnavailable when raw
    rows of a series are needed and there is none; with `allow_missing` such a series has its stored rows
    only. No request gives no row.

    The raw part spans the demand records that the source returned, so a hole before its first record stays
    out of sight; with `close_gap` its grid starts where the missing range starts.
    """
    if use_store:
        split = staged(hit_miss(read_chunk_index(spark, store), requests, step), "hit-miss")
        hits = split.filter("hit_start is not null").select(
            "series_id", F.col("hit_start").alias("start_ts"), F.col("hit_end").alias("end_ts")
        )
        misses = split.filter("miss_start is not null").select(
            "series_id", F.col("miss_start").alias("start_ts"), F.col("miss_end").alias("end_ts")
        )
    else:
        hits, misses = None, requests

    parts = []
    if hits is not None:
        span = hits.agg(F.min("start_ts").alias("low"), F.max("end_ts").alias("high")).first()
        if span.low is not None:
            parts.append(read_ranges(spark, store, hits, step, span.low, span.high))
    if misses.isEmpty():
        return parts[0] if parts else spark.createDataFrame([], SERIES)
    fetched = staged(fetch_raw(raw, misses, step), "fetched")
    if not allow_missing:
        without = misses.join(fetched.select("series_id").distinct(), "series_id", "left_anti").select("series_id")
        some = [row.series_id for row in without.limit(5).collect()]
        if some:
            raise DataUnavailable(f"the raw source has no rows in the missing range of {', '.join(map(str, some))}")
    bounds = time_bounds(fetched)
    if close_gap:
        wanted = misses.select("series_id", F.col("start_ts").alias("_from"))
        bounds = bounds.join(wanted, "series_id").withColumn("start_ts", F.least("start_ts", "_from"))
    parts.append(typed_to_warehouse(fetched, step, bounds))
    # The two parts never share a step, so no de-duplication is needed.
    return concat(parts)


def read_ranges(
    spark: SparkSession,
    store: str,
    ranges: DataFrame,
    step: timedelta,
    low: datetime,
    high: datetime,
) -> DataFrame:
    """Stored rows inside any of their series' ranges, all of which lie in [low, high].

    Only parts that a range of one of their series touches are opened: a new series that needs three years of history
    does not make the others' buckets be read. A series has few ranges (merged back-fill ranges, or one hit range), so
    they travel as one array per series.
    """
    per_series = ranges.groupBy("series_id").agg(
        F.collect_list(F.struct("start_ts", "end_ts")).alias("_ranges")
    )
    rows = read_range(spark, store, low, high, touched_parts(spark, store, ranges))
    return (
        lookup(rows, per_series, ["series_id"], how="inner")
        .filter(F.exists("_ranges", lambda r: F.col("ts").between(r["start_ts"], r["end_ts"])))
        .drop("_ranges")
    )


def touched_parts(spark: SparkSession, store: str, ranges: DataFrame) -> set[Part]:
    """The stored parts that hold a step of one of the ranges (series_id, start_ts, end_ts): at most one row a part is collected."""
    _, buckets = _places(spark, store)
    if not buckets:
        return set()
    quarters = F.sequence(F.trunc("start_ts", "quarter"), F.to_date("end_ts"), F.expr("interval 3 months"))
    days = ranges.filter("start_ts <= end_ts").select("series_id", F.explode(quarters).alias("_day"))
    chunks = days.select("series_id", F.year("_day").alias("year"), F.quarter("_day").alias("quarter"))
    return set(_parts(chunks, buckets))
