"""A corpus pipeline: quality rules, line dedup, near-dedup, mixing, tokens.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as the
docs of the next one. All but the last return the columns of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import lines, mixing, rules, simhash, transducer
from hourloom.llm.common import find, staged, text_marks

MODEL = "piece_bpe_32k.model"
# Near duplicates: sets of five-word shingles of a Jaccard similarity of 0.8. Fingerprints of 64-bit words choose the pairs that
# are counted, by the bits in which all of them differ. Two large sets of similarity 0.8 differ in 78 of 512 bits on average,
# sets of 4 and 5 shingles (the most) in 96, unrelated ones in 256.
SIMILARITY = 0.8
SHINGLE, WORDS, FULL_RADIUS = 5, 8, 150


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep; all rows of a doc_id share its verdict only if their texts do."""
    judged = rules.judge(docs).where("not kept").select("doc_id", "t1", "t2").distinct()
    return _without(docs, judged)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a smaller doc_id keeps; n_chars follows the text."""
    done = lines.drop_shared_lines(docs)
    text, chars = find(docs, "text"), find(docs, "n_chars", missing=-1)
    columns = []
    for k, name in enumerate(docs.columns):
        value = F.col(f"row.c{k}")
        if k == text:
            value = F.when(value.isNull(), value).otherwise(F.col("kept"))
        elif k == chars:
            value = F.when(F.col("n_dropped") > 0, F.length("kept")).otherwise(value).cast(docs.schema[k].dataType)
        columns.append(value.alias(f"c{k}"))
    return done.select(columns).toDF(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one of the smallest doc_id. Rows without a doc_id stay."""
    groups = simhash.similar_documents(docs, SIMILARITY, shingle=SHINGLE, words=WORDS, full_radius=FULL_RADIUS)
    dropped = groups.where("doc_id <> component_id").select("doc_id").distinct()
    names = [f"c{k}" for k in range(len(docs.columns))]
    kept = docs.toDF(*names).join(dropped, F.col(names[find(docs, "doc_id")]) == F.col("doc_id"), "left_anti")
    return kept.toDF(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of the mixture."""
    return mixing.mixed(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document and the hash of what they decode to."""
    return transducer.encode(docs, public_tokenizers.path(MODEL))


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("SimHash near-dedup", near_dedup),
    ("mixing sources", mix_sources),
    ("SentencePiece", sentencepiece),
]
# SQL has no fingerprints and no pieces; the stages are tested against brute force.
ORACLE_SQL = None


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """Rows of `docs` whose doc_id and text are not in `rejected` (doc_id, t1, t2)."""
    names = [f"c{k}" for k in range(len(docs.columns))]
    rows = docs.toDF(*names)
    doc_id, text = F.col(names[find(docs, "doc_id")]), F.col(names[find(docs, "text")])
    t1, t2 = text_marks(text)
    same = doc_id.eqNullSafe(F.col("doc_id")) & (t1 == F.col("t1")) & (t2 == F.col("t2"))
    return rows.join(rejected, same, "left_anti").toDF(*docs.columns)


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = staged(docs, name.replace(" ", "-"))
    return docs
