"""Line dedup: lines that several documents share stay in one of them only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, find, pick, staged, stripped, text_marks

MIN_KEY_CHARS, MIN_DOCUMENTS = 10, 2


def _split(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _marks(text: Column) -> Column:
    h1, h2 = text_marks(text)
    return F.struct(h1.alias("h1"), h2.alias("h2"))


def shared_lines(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(h1, h2, keeper): the hash of every key found in `min_documents` documents or more, and its smallest doc_id.

    A line's key is the line without white space at its ends, A-Z lower-cased; keys under `min_chars`
    characters are left out. Repeats within a document are put together before the documents are counted,
    and both steps combine on the map side, so a very common line costs one row per task.
    """
    keys = (
        pick(docs, doc_id="doc_id", text="text")
        .where("doc_id is not null")
        .select("doc_id", F.explode(_split(F.col("text"))).alias("line"))
        .select("doc_id", ascii_lower(stripped(F.col("line"))).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", _marks(F.col("key")).alias("m"))
        .select("doc_id", "m.*")
    )
    if min_documents <= 2:
        counted = keys.groupBy("h1", "h2").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last"))
        return counted.where("keeper < last" if min_documents == 2 else "true").select("h1", "h2", "keeper")
    counted = keys.distinct().groupBy("h1", "h2").agg(F.min("doc_id").alias("keeper"), F.count("*").alias("n"))
    return counted.where(F.col("n") >= min_documents).select("h1", "h2", "keeper")


def dropped_places(docs: DataFrame, min_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(doc_id, t1, t2, places): for each text that loses lines, the places of those lines, from 0.

    t1 and t2 stand for the text, so that documents that share a doc_id keep their own places.
    """
    lines = (
        pick(docs, doc_id="doc_id", text="text")
        .where("doc_id is not null")
        .select("doc_id", _marks(F.col("text")).alias("t"), F.posexplode(_split(F.col("text"))).alias("place", "line"))
        .select("doc_id", "t", "place", ascii_lower(stripped(F.col("line"))).alias("key"))
        .where(F.length("key") >= min_chars)
        .select("doc_id", F.col("t.h1").alias("t1"), F.col("t.h2").alias("t2"), "place", _marks(F.col("key")).alias("m"))
        .select("doc_id", "t1", "t2", "place", "m.*")
    )
    shared = staged(shared_lines(docs, min_chars, min_documents), "shared-lines")
    return (
        lines.join(shared, ["h1", "h2"])
        .where("doc_id <> keeper")
        .groupBy("doc_id", "t1", "t2")
        .agg(F.collect_set("place").alias("places"))
    )


def drop_shared_lines(
    docs: DataFrame, min_chars: int = MIN_KEY_CHARS, min_documents: int = MIN_DOCUMENTS
) -> DataFrame:
    """Every row of `docs` (doc_id, text) with its lines after the dedup: doc_id, n_lines, n_dropped, kept, row.

    kept is the text of the lines left, joined by line feeds; row is a struct of all columns of `docs`
    in their order. A null or empty text is one empty line. Rows without a doc_id belong to no document:
    they neither count nor lose lines. Repeated rows of a doc_id are one document and are treated alike.
    An empty table gives an empty one.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    places = dropped_places(docs, min_chars, min_documents)
    rows = docs.toDF(*names).select(F.struct(*names).alias("row"))
    text = F.col(f"row.{names[find(docs, 'text')]}")
    rows = rows.select(F.col(f"row.{names[find(docs, 'doc_id')]}").alias("doc_id"), _marks(text).alias("t"), "row")
    joined = rows.select("doc_id", F.col("t.h1").alias("t1"), F.col("t.h2").alias("t2"), "row").join(
        places, ["doc_id", "t1", "t2"], "left"
    )
    lines = _split(text)
    left = F.when(F.col("places").isNull(), F.coalesce(text, F.lit(""))).otherwise(
        F.array_join(F.filter(lines, lambda s, k: ~F.array_contains("places", k)), "\n")
    )
    return joined.select(
        "doc_id",
        F.size(lines).cast("long").alias("n_lines"),
        F.coalesce(F.size("places"), F.lit(0)).cast("long").alias("n_dropped"),
        left.alias("kept"),
        "row",
    )
