"""Raw records that arrive in JSON pages."""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property
from importlib import import_module
from urllib.parse import unquote, urlparse

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    LessThan,
    LessThanOrEqual,
)

from hourloom.consts import MAX_PAGE_ROWS
from hourloom.functions.time import ceil_div
from hourloom.schemas import RAW_PAGE, RAW_RECORD

PAGED_RECORD = T.StructType(RAW_RECORD.fields + [T.StructField("position", T.LongType())])


def page_plan(totals: DataFrame, page_size: int = MAX_PAGE_ROWS) -> DataFrame:
    """Pages (series_id, page_no, offset, length) that cover `total` records per series.

    Full pages and one shorter page for the remainder; no page of length zero.
    """
    pages = ceil_div(F.col("total"), F.lit(page_size))
    return (
        totals.filter("total > 0")
        .select("series_id", "total", F.explode(F.sequence(F.lit(0).cast("bigint"), pages - 1)).alias("page_no"))
        .withColumn("offset", F.col("page_no") * page_size)
        .select(
            "series_id",
            "page_no",
            "offset",
            F.least(F.lit(page_size), F.col("total") - F.col("offset")).cast("bigint").alias("length"),
        )
    )


def parse_pages(pages: DataFrame, body: str = "body", offset: str | Column | None = None) -> DataFrame:
    """JSON pages to raw records, each with its position in the whole answer."""
    offset = F.lit(0) if offset is None else (F.col(offset) if isinstance(offset, str) else offset)
    return (
        pages.select(
            offset.cast("bigint").alias("_offset"),
            F.posexplode(F.from_json(body, RAW_PAGE)["response"]["data"]).alias("_pos", "_record"),
        )
        .select("_record.*", (F.col("_offset") + F.col("_pos")).alias("position"))
    )


@dataclass(frozen=True)
class PageQuery:
    """What a request asks for: facets (None: all) and periods from `start` to `end`, both included, as ISO text (None: open)."""

    types: tuple[str, ...] | None = None
    start: str | None = None
    end: str | None = None


class FilePages:
    """Page reader over a folder ``respondent=<id>/offset=<n>/`` of JSON page files.

    Any object with ``series()``, ``total(series_id, query)`` and ``page(series_id, offset, length, query)`` can take its
    place, an API client for one. ``answers_queries`` says whether it can ask for facets and periods; offsets then count the
    records of the answer. Files hold whole answers, so this one cannot.
    """

    answers_queries = False

    def __init__(self, options: dict[str, str]):
        place = urlparse(options["path"])
        if place.scheme in ("", "file"):
            self.files, self.root = fs.LocalFileSystem(), place.path
        else:
            self.files, self.root = fs.FileSystem.from_uri(options["path"])

    @cached_property
    def folders(self) -> dict[str, str]:
        """Folder of each series; names are percent-escaped where a path needs it."""
        found = self.files.get_file_info(fs.FileSelector(self.root))
        names = [f.base_name for f in found if f.base_name.startswith("respondent=")]
        return {unquote(name.split("=", 1)[1]): name for name in names}

    def series(self) -> list[str]:
        return sorted(self.folders)

    def _page(self, series_id: str, offset: int) -> dict:
        folder = f"{self.root}/{self.folders[series_id]}/offset={offset}"
        text = ""
        for info in self.files.get_file_info(fs.FileSelector(folder)):
            if info.is_file and info.base_name.startswith("part-"):
                with self.files.open_input_stream(info.path) as stream:
                    text += stream.read().decode()
        return json.loads(text)["response"]

    def total(self, series_id: str, query: PageQuery) -> int:
        return int(self._page(series_id, 0)["total"])

    def page(self, series_id: str, offset: int, length: int, query: PageQuery) -> list[dict]:
        records = self._page(series_id, offset)["data"]
        if len(records) > length:
            raise ValueError(f"page {series_id}/{offset} has {len(records)} records, not {length}")
        return records


class Pages(InputPartition):
    """Every `tasks`-th page of a series, from page `first`."""

    def __init__(self, series_id: str, first: int, tasks: int):
        self.series_id, self.first, self.tasks = series_id, first, tasks


class PagedReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.options, self.wanted, self.query = options, None, PageQuery()

    @cached_property
    def _client(self):
        module, name = self.options.get("fetcher", "hourloom.sources.paged:FilePages").split(":")
        return getattr(import_module(module), name)(self.options)

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Series by name, and facets and periods where the client can ask for them.

        A series or facet that is asked for by name is all that is answered, so Spark need not look again. Periods are
        asked for with both ends included and left to Spark as well, for sharp ends.
        """
        asks = getattr(self._client, "answers_queries", False)
        for f in filters:
            column = f.attribute[0] if len(getattr(f, "attribute", ())) == 1 else None
            values = (f.value,) if isinstance(f, EqualTo) else tuple(f.value) if isinstance(f, In) else None
            if values is not None and column == "respondent":
                self.wanted = set(values) if self.wanted is None else self.wanted & set(values)
            elif values is not None and column == "type" and asks:
                known = self.query.types
                both = values if known is None else tuple(v for v in values if v in known)
                self.query = replace(self.query, types=both)
            else:
                if column == "period" and asks and isinstance(f, GreaterThan | GreaterThanOrEqual):
                    self.query = replace(self.query, start=max(f.value, self.query.start or f.value))
                elif column == "period" and asks and isinstance(f, LessThan | LessThanOrEqual):
                    self.query = replace(self.query, end=min(f.value, self.query.end or f.value))
                yield f

    def partitions(self) -> list[InputPartition]:
        """`tasks_per_series` tasks for each series that is wanted; no record is asked for, totals are found in the tasks."""
        tasks = int(self.options.get("tasks_per_series", 2))
        series = self._client.series()
        if self.wanted is not None:
            series = [s for s in series if s in self.wanted]
        return [Pages(s, k, tasks) for s in series for k in range(tasks)] or [Pages("", 0, 0)]

    def read(self, partition: Pages) -> Iterator[pa.RecordBatch]:
        if not partition.tasks:
            return
        size = int(self.options.get("page_size", MAX_PAGE_ROWS))
        names = [f.name for f in RAW_RECORD]
        total = self._client.total(partition.series_id, self.query)
        for offset in range(partition.first * size, total, partition.tasks * size):
            records = self._client.page(partition.series_id, offset, min(size, total - offset), self.query)
            columns = [pa.array([r.get(n) for r in records], pa.string()) for n in names]
            columns.append(pa.array(range(offset, offset + len(records)), pa.int64()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "position"])


class PagedJson(DataSource):
    """``spark.read.format("paged_json")`` with options path, page_size, tasks_per_series, fetcher."""

    @classmethod
    def name(cls) -> str:
        return "paged_json"

    def schema(self) -> T.StructType:
        return PAGED_RECORD

    def reader(self, schema: T.StructType) -> PagedReader:
        return PagedReader(dict(self.options))


def read_paged(spark: SparkSession, **options: str) -> DataFrame:
    """The records of all pages. Filters on respondent, and on type and period where the client can, reach its requests."""
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(PagedJson)
    return spark.read.format("paged_json").options(**options).load()
