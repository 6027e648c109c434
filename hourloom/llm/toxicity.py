"""Toxicity: boosted trees over dense features of a text, with isotonic calibration.

The lexicon has two parts: a fixed list, and words and word beginnings that labelled toxic documents use far more often
than others. The labelled rows are split: some teach the learned part, others the trees, others the calibration, so that no
step sees the rows that the one before it was fitted to.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import pick, staged

# Insulting words of four languages.
LEXICON = frozenset(
    """
    idiot idiots moron morons stupid dumb dumbass imbecile cretin loser losers scum trash garbage filth filthy pathetic
    worthless disgusting clown clowns fool jerk bastard bitch asshole crap shit fuck fucking damn ugly hate kill die
    vermin parasite pig swine coward liar freak creep retard whore slut dickhead
    dumm dummkopf blöd blödmann trottel depp arschloch scheisse scheiße abschaum müll wertlos widerlich ekelhaft
    verlierer schwein hässlich feigling
    idiota idiotas estúpido estúpida imbécil tonto basura escoria asqueroso perdedor inútil patético mierda cabrón
    puta payaso cerdo cobarde
    stupide imbécile abruti connard salaud ordure déchet dégoûtant perdant minable pathétique merde putain pute
    """.split()
)
# Second-person words of the same languages.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine ihr euch tú tu te ti usted ustedes vosotros toi ton ta tes vous votre vos".split()
)
FOLDS, HELD_OUT, TREE_FOLD, CALIBRATION_FOLD = 5, 0, 3, 4
MAX_LABELLED, TREES, DEPTH, NEAR = 40_000, 30, 4, 6
MAX_TERMS, LEAST_TOXIC, LEAST_ODDS, BEGINNINGS = 5_000, 4, 8.0, (3, 4, 5, 6, 7)
KNOWN_WORDS, LONGEST_TERM = 500_000, 40
FEATURES = (
    "log_words hits_rate log_hits distinct_hits hidden_hits_rate second_rate near_second capitals caps_words "
    "marks mark_runs mixed_words stretched learned_rate log_learned distinct_learned learned_weight largest_weight"
).split()

_WORD = re.compile(r"\w+")
_MARKS = re.compile(r"[!?]+")
_INNER = re.compile(r"[0-9@$!|*]+")
_CAPS = re.compile(r"[A-Z]{3,}")
_CAPITAL = re.compile(r"[A-ZÀ-ÖØ-Þ]")
_STRETCH = re.compile(r"([^\W\d_])\1\1")
_FOLD = str.maketrans("013457@$!|*", "oieastasiii")


class Weights(dict):
    """The largest log-odds of a word and its beginnings among the learned terms, kept for each word seen.

    `stretched` has those of the words seen that have a letter three times in a row.
    """

    def __init__(self, terms: dict[str, float]):
        self.terms = terms
        self.stretched: set[str] = set()

    def __missing__(self, word: str) -> float:
        get = self.terms.get
        weight = max([get("=" + word, 0.0), *(get(word[:k], 0.0) for k in BEGINNINGS if k <= len(word))])
        self[word] = weight
        if _STRETCH.search(word):
            self.stretched.add(word)
        return weight

    def trim(self) -> None:
        """Forget the words seen if they are many; between texts only, since a text counts on its own words."""
        if len(self) >= KNOWN_WORDS:
            self.clear()
            self.stretched.clear()


def features(text: str, weights: Weights) -> list[float]:
    """The dense features of a whole text, in the order of FEATURES; an empty one gives zeros."""
    weights.trim()
    low = text.lower()
    tokens = _WORD.findall(low)
    n = len(tokens)
    if not n:
        return [0.0] * len(FEATURES)
    hits = [] if LEXICON.isdisjoint(tokens) else [k for k, w in enumerate(tokens) if w in LEXICON]
    values = [weights[w] for w in tokens]
    learned = [k for k, v in enumerate(values) if v]
    both = sorted({*hits, *learned})
    near = sum(not SECOND_PERSON.isdisjoint(tokens[max(0, k - NEAR) : k + NEAR + 1]) for k in both)
    second = sum(map(SECOND_PERSON.__contains__, tokens))
    mixed, hidden = 0, set()
    for m in _INNER.finditer(low):
        i, j = m.span()
        if 0 < i and j < len(low) and low[i - 1].isalpha() and low[j].isalpha():
            mixed += 1
            while i and not low[i - 1].isspace() and m.start() - i < LONGEST_TERM:
                i -= 1
            while j < len(low) and not low[j].isspace() and j - m.end() < LONGEST_TERM:
                j += 1
            if not LEXICON.isdisjoint(_WORD.findall(low[i:j].translate(_FOLD))):
                hidden.add(i)
    marks = _MARKS.findall(text)
    capitals = len(_CAPITAL.findall(text))
    return [
        float(np.log1p(n)),
        100.0 * len(hits) / n,
        float(np.log1p(len(hits))),
        float(len({tokens[k] for k in hits})),
        100.0 * len(hidden) / n,
        100.0 * second / n,
        near / len(both) if both else 0.0,
        capitals / len(text),
        100.0 * len(_CAPS.findall(text)) / n,
        100.0 * sum(map(len, marks)) / len(text),
        100.0 * sum(len(m) > 1 for m in marks) / n,
        100.0 * mixed / n,
        100.0 * sum(map(weights.stretched.__contains__, tokens)) / n if weights.stretched else 0.0,
        100.0 * len(learned) / n,
        float(np.log1p(len(learned))),
        float(len({tokens[k] for k in learned})),
        100.0 * sum(values) / n,
        max(values),
    ]


def learned_terms(rows: DataFrame) -> dict[str, float]:
    """Log-odds of the words (behind an equals sign) and word beginnings of `rows` (text, label) that are far more
    frequent, by documents, among those with label 1. At most MAX_TERMS, the most telling ones."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = {0.0: Counter(), 1.0: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                found = {w for w in _WORD.findall((text or "").lower()) if len(w) <= LONGEST_TERM}
                seen[label].update({w[:k] for w in found for k in BEGINNINGS if k <= len(w)} | {"=" + w for w in found})
        for label, counts in seen.items():
            if counts:
                yield pd.DataFrame({"term": list(counts), "label": label, "n": list(counts.values())})

    sizes = {r.label: r["count"] for r in rows.groupBy("label").count().collect()}
    toxic, clean = (F.sum(F.when(F.col("label") == k, F.col("n")).otherwise(0)) for k in (1.0, 0.0))
    counted = rows.mapInPandas(count, "term string, label double, n long").groupBy("term")
    odds = ((F.col("toxic") + 0.5) / (sizes.get(1.0, 0) + 1)) / ((F.col("clean") + 0.5) / (sizes.get(0.0, 0) + 1))
    best = (
        counted.agg(toxic.alias("toxic"), clean.alias("clean"))
        .withColumn("odds", odds)
        .where((F.col("toxic") >= LEAST_TOXIC) & (F.col("odds") >= LEAST_ODDS))
        .orderBy(F.desc("odds"), F.desc("toxic"), "term")
        .limit(MAX_TERMS)
    )
    return {r.term: float(np.log(r.odds)) for r in best.collect()}


def measured(docs: DataFrame, terms: dict[str, float]) -> DataFrame:
    """(doc_id, x) with the features of every row of `docs` (doc_id, text); a null text counts as empty."""
    rows = pick(docs, doc_id="doc_id", text="text")
    shared = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        weights = Weights(shared.value)
        for batch in batches:
            batch["x"] = [features(t or "", weights) for t in batch.pop("text")]
            yield batch

    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, x array<double>")


def score(docs: DataFrame, labels: DataFrame, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of `docs` (doc_id, text), learned from `labels` (doc_id, toxic).

    Documents whose crc32(doc_id as text) mod 5 is 0 are held out. Of the other labelled ones, about
    `max_labelled` at most (chosen by a hash of doc_id) teach: remainders 1 and 2 the lexicon, 3 the trees and 4 the
    calibration. Labels other than 0 and 1 are left out; a document with both counts as toxic. Unless both labels
    occur for the trees and for the calibration, every score is the share of toxic ones there (0 without any). A null text is scored like an empty
    one, a null doc_id is not held out and never teaches. Repeated rows are scored alike; an empty table gives an empty one.
    """
    remainder = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS))
    teaching = (
        pick(labels, doc_id="doc_id", toxic="toxic")
        .where("toxic in (0, 1) and doc_id is not null")
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("double").alias("label"))
        .withColumn("fold", remainder)
        .where(F.col("fold") != HELD_OUT)
    )
    share = min(1.0, max_labelled / max(1, teaching.count()))
    chosen = teaching.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int(share * (1 << 30)))
    chosen = staged(chosen, "chosen")  # bounded by max_labelled, so it may be broadcast
    texts = pick(docs, doc_id="doc_id", text="text").join(F.broadcast(chosen.where(F.col("fold") < TREE_FOLD)), "doc_id")
    all_rows = staged(measured(docs, learned_terms(texts.select("text", "label"))), "features")
    rows = all_rows.select("doc_id", array_to_vector("x").alias("features"))
    later = chosen.where(F.col("fold") >= TREE_FOLD)
    sample = staged(rows.join(F.broadcast(later), "doc_id").repartition(8, "doc_id"), "labelled")
    calibrating = F.col("fold") == CALIBRATION_FOLD
    counts = {(r.c, r.label): r.n for r in sample.groupBy(calibrating.alias("c"), "label").agg(F.count("*").alias("n")).collect()}
    if len(counts) == 4:
        trees = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.2, subsamplingRate=0.8, seed=1, cacheNodeIds=False)
        model = trees.fit(sample.where(~calibrating))
        margin = vector_to_array("rawPrediction")[1].alias("margin")
        isotonic = IsotonicRegression(featuresCol="margin", labelCol="label", predictionCol="score")
        curve = isotonic.fit(model.transform(sample.where(calibrating)).select(margin, "label"))
        scored = curve.transform(model.transform(rows).select("doc_id", margin))
    else:
        toxic, total = sum(n for (_, label), n in counts.items() if label), sum(counts.values())
        scored = rows.withColumn("score", F.lit(toxic / total if total else 0.0))
    value = F.least(F.lit(1.0), F.greatest(F.lit(0.0), "score"))
    return scored.select(
        "doc_id",
        F.coalesce(remainder == HELD_OUT, F.lit(False)).alias("held_out"),
        value.alias("score"),
        F.when(value >= 0.5, 1).otherwise(0).alias("predicted"),
    )
