"""The named queries of this package over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hourloom.llm import collocations, graph, langid, lines, merkle, mixing, prefix, rules, simhash, sphere, toxicity, transducer, urls
from hourloom.llm.oracles import ORACLES  # noqa: F401

QUERIES = {}
MODEL, TOKEN_LIMIT = "piece_bpe_32k.model", 4096
URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def query(run):
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.judge(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


@query
def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_shared_lines(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256")
    )


@query
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return transducer.encode(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = prefix.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return mixing.schedule(docs).select("row.c0", "row.c1", "slot", "place").toDF("doc_id", "source", "slot", "place")


@query
def op8_embedding_caps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sphere.near_duplicates(table(spark, sf_dir, "embeddings"))


@query
def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query
def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return urls.judge(pages, URL_RULES, texts=pages.select(F.col("html").alias("text")))


@query
def op11_graph_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return graph.nearest_neighbours(table(spark, sf_dir, "embeddings"))


@query
def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verify(table(spark, sf_dir, "documents"))


@query
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.best(collocations.mine(table(spark, sf_dir, "documents")))
