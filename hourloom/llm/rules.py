"""Quality rules: word and line counts, and how far a document's histograms are from its language's."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import SPACE_CLASS, bound_to, pick, staged, text_marks, words

# Frequent function words of four languages.
COMMON_WORDS = {
    "de": ("der", "die", "und", "in", "den", "von", "zu", "das", "mit", "sich", "des", "auf"),
    "en": ("the", "of", "and", "to", "in", "a", "is", "that", "it", "for", "on", "was"),
    "es": ("de", "la", "que", "el", "en", "y", "los", "del", "se", "las", "por", "un"),
    "fr": ("de", "la", "le", "et", "les", "des", "en", "un", "du", "une", "que", "est"),
}
# Characters by class; those of no class here form the last one.
CLASSES = {
    "upper": "[A-Z]+",
    "digit": "[0-9]+",
    "space": SPACE_CLASS + "+",
    "symbol": r"[#*$%&|<>]+",
    "punctuation": r"[.,;:!?'\"()/-]+",
    "wide": r"[^\x00-\x7F]+",
}
MIN_WORDS, MAX_REPEATED_PERCENT = 50, 50
MIN_COMPARED_WORDS, MIN_COMPARED_CHARS = 100, 400
MAX_CLASS_DISTANCE, MAX_WORD_DISTANCE = 0.32, 0.275


def _repeat_words(parts: Column) -> Column:
    """Words in windows of three words that occur twice or more in the array.

    Windows are compared by a 64-bit hash next to their place: sorting brings equal ones together,
    so the cost is that of sorting one document's words.
    """
    windows = F.transform(
        F.sequence(F.lit(0), F.size(parts) - 3),
        lambda k: F.struct(F.xxhash64(F.get(parts, k), F.get(parts, k + 1), F.get(parts, k + 2)).alias("h"), k.alias("k")),
    )

    def covered(ordered: Column) -> Column:
        neighbours = F.arrays_zip(ordered.alias("x"), F.slice(ordered, 2, F.size(ordered)).alias("y"))
        same = F.filter(neighbours, lambda z: z["x"]["h"] == z["y"]["h"])
        starts = F.flatten(F.transform(same, lambda z: F.array(z["x"]["k"], z["y"]["k"])))
        return F.size(F.array_distinct(F.flatten(F.transform(F.array_distinct(starts), lambda k: F.array(k, k + 1, k + 2)))))

    return F.when(F.size(parts) < 4, 0).otherwise(bound_to(F.sort_array(windows), covered))


def _counter(listed: Sequence[str]):
    """How often each listed word occurs in an array of words."""
    wanted = F.array(*[F.lit(w) for w in listed])
    return lambda hits: F.transform(wanted, lambda w: F.size(F.filter(hits, lambda x: x == w)).cast("long"))


def measure(docs: DataFrame, common: Mapping[str, Sequence[str]] = COMMON_WORDS) -> DataFrame:
    """Counts of every document: the base counts, characters by class and common words of its language.

    Columns doc_id, lang, t1 and t2 (they stand for the text), n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, classes and
    common (arrays of long, the last entry counts the rest). A null text counts as an empty one; a
    language without a word list has `common` null. Rows are kept as they are, repeated ones too.
    """
    text = F.coalesce("text", F.lit(""))
    t1, t2 = text_marks(F.col("text"))
    base = pick(docs, doc_id="doc_id", text="text", lang="lang").select(
        "doc_id", "lang", t1.alias("t1"), t2.alias("t2"), text.alias("text")
    )
    lines = F.filter(F.split("text", "\n"), lambda s: F.length(F.btrim(s, F.lit(" \t\x0b\x0c\r"))) > 0)
    every = sorted({w for ws in common.values() for w in ws})
    chars = F.length("text")

    def of_words(parts: Column) -> Column:
        hits = F.filter(parts, lambda w: w.isin(every))
        of_language = None
        for language, listed in sorted(common.items()):
            counts = bound_to(hits, _counter(listed))
            of_language = (F if of_language is None else of_language).when(F.col("lang") == language, counts)
        return F.struct(
            F.size(parts).cast("long").alias("n_words"),
            F.length(F.array_join(parts, "")).cast("long").alias("word_chars"),
            _repeat_words(parts).cast("long").alias("n_repeat_words"),
            of_language.alias("common"),
        )

    counted = base.select(
        "doc_id",
        "lang",
        "t1",
        "t2",
        bound_to(words(F.col("text")), of_words).alias("w"),
        bound_to(lines, lambda x: (F.size(x) - F.size(F.array_distinct(x))).cast("long")).alias("n_dup_lines"),
        *[(chars - F.length(F.regexp_replace("text", p, ""))).cast("long").alias(c) for c, p in CLASSES.items()],
        chars.cast("long").alias("chars"),
    )
    known = sum((F.col(c) for c in CLASSES), F.lit(0).cast("long"))
    listed = F.aggregate("w.common", F.lit(0).cast("long"), lambda a, b: a + b)
    return counted.select(
        "doc_id",
        "lang",
        "t1",
        "t2",
        "w.n_words",
        "w.word_chars",
        F.col("symbol").alias("n_symbols"),
        "n_dup_lines",
        "w.n_repeat_words",
        F.array(*CLASSES, F.col("chars") - known).alias("classes"),
        F.concat("w.common", F.array(F.col("w.n_words") - listed)).alias("common"),
    )


def references(measured: DataFrame, n_common: int) -> DataFrame:
    """One row per language: the summed histograms of all its documents (`class_ref`, `word_ref`)."""
    sums = [F.sum(F.col("classes")[k]).alias(f"c{k}") for k in range(len(CLASSES) + 1)]
    sums += [F.sum(F.get("common", F.lit(k))).alias(f"w{k}") for k in range(n_common)]
    return (
        measured.where("lang is not null")
        .groupBy("lang")
        .agg(*sums)
        .select(
            "lang",
            F.array(*[f"c{k}" for k in range(len(CLASSES) + 1)]).alias("class_ref"),
            F.when(F.col("w0").isNotNull(), F.array(*[f"w{k}" for k in range(n_common)])).alias("word_ref"),
        )
    )


def divergence(own: Column, reference: Column) -> Column:
    """Jensen-Shannon distance (base 2, 0 to 1) of two histograms; null where either is null or empty."""

    def total(h: Column) -> Column:
        return F.aggregate(h, F.lit(0.0), lambda a, b: a + b.cast("double"))

    def part(x: Column, m: Column) -> Column:
        return F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)

    def over(sums: Column) -> Column:
        def term(a: Column, b: Column) -> Column:
            p, q = a / sums["p"], b / sums["q"]
            return 0.5 * (part(p, (p + q) / 2) + part(q, (p + q) / 2))

        parts = F.zip_with(own, reference, term)
        return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(parts, F.lit(0.0), lambda a, b: a + b)))

    sums = F.struct(total(own).alias("p"), total(reference).alias("q"))
    return F.when((total(own) > 0) & (total(reference) > 0), bound_to(sums, over))


def judge(
    docs: DataFrame,
    common: Mapping[str, Sequence[str]] = COMMON_WORDS,
    max_class_distance: float = MAX_CLASS_DISTANCE,
    max_word_distance: float = MAX_WORD_DISTANCE,
) -> DataFrame:
    """The counts and verdict of every row of `docs` (doc_id, text, lang).

    Adds base_failed (under 50 words, or over half of the words in repeated windows of three),
    class_distance, word_distance and kept. The references are the summed histograms of all documents of
    a language. Texts under 400 characters or 100 words, rows without a language and languages without a
    word list are not compared (that distance is null and rejects nothing): short histograms lie far from
    any reference by chance. Null or empty texts have no words and fail. Repeated rows are judged alike;
    an empty table gives an empty one.
    """
    sizes = {len(ws) for ws in common.values()}
    if len(sizes) != 1:
        raise ValueError("all word lists need the same length")
    measured = staged(measure(docs, common), "measured")
    joined = measured.join(references(measured, sizes.pop() + 1), "lang", "left")
    long_enough = F.col("n_words") >= MIN_COMPARED_WORDS
    enough_chars = F.aggregate("classes", F.lit(0).cast("long"), lambda a, b: a + b) >= MIN_COMPARED_CHARS
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    judged = joined.select(
        "doc_id",
        "t1",
        "t2",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        failed.alias("base_failed"),
        F.when(enough_chars, divergence(F.col("classes"), F.col("class_ref"))).alias("class_distance"),
        F.when(long_enough, divergence(F.col("common"), F.col("word_ref"))).alias("word_distance"),
    )
    far = (F.coalesce("class_distance", F.lit(0.0)) > max_class_distance) | (
        F.coalesce("word_distance", F.lit(0.0)) > max_word_distance
    )
    return judged.withColumn("kept", ~F.col("base_failed") & ~far)
