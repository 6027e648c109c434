"""URL filters: longest matching rule, else naive Bayes over the words of the host and the path."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import ascii_lower, pick, staged

ALLOW, BLOCK = "allow", "block"
LONGEST_WORD, MAX_TERMS = 20, 50_000
BLOCKED_SHARE = 0.3  # of the web, before anything is known of a url
# Site names by what they offer, from which the classifier learns.
EXAMPLES = (
    (
        BLOCK,
        """casino-online poker-slots casino-win free-bets best-bets sports-betting jackpot-win lottery-win roulette-bonus
        cheap-pills online-pharmacy viagra-cheap cialis-pills buy-pills diet-pills adult-video adult-x xxx-video porn-tube
        sex-cams nude-pics escort-girls hot-singles ads-track ad-click track-pixel banner-ads click-ads pop-ads
        spam-farm link-farm seo-spam free-money easy-money payday-loans crypto-win warez-crack torrent-crack
        keygen-crack replica-watches phishing-login malware-download hack-tool""",
    ),
    (
        ALLOW,
        """news-daily city-news weather-report science-journal open-library public-library state-university school-district
        history-museum art-museum travel-guide cooking-recipes garden-tips health-center hospital-info research-institute
        data-docs code-docs software-manual language-dictionary world-atlas music-review book-review film-review
        sports-club football-league government-portal city-council community-forum help-wiki encyclopedia
        free-software open-source online-learning photo-gallery family-history radio-station magazine-archive bank-service train-schedule local-market""",
    ),
)


def parsed(url: Column) -> tuple[Column, Column]:
    """(host, path) of a url: both empty for a null or one without `://`."""
    at = F.instr(F.coalesce(url, F.lit("")), "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, "^[^/?#]*", 0)), F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of `rules` (verdict, `host/path`) that fits, as a struct (size, rule, verdict); null if none does.

    A rule fits its host and its subdomains where the path starts with the rule's. Of equal rules the last counts.
    """
    found = []
    for verdict, rule in {r: (v, r) for v, r in rules}.values():
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        found.append(F.when(fits, F.struct(F.lit(len(rule)).alias("size"), F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    none = F.lit(None).cast("struct<size:int,rule:string,verdict:string>")
    return F.array_max(F.array(none, *found))


def _names(host: Column) -> Column:
    """The runs of letters of a host without its top-level domain."""
    return F.regexp_extract_all(F.regexp_replace(host, r"(:[0-9]*)?$|\.[^.]*$", ""), F.lit(r"\p{L}+"), 0)


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, n) over the column `text`: lower-cased runs of letters outside of mark-up, of up to 20 letters."""
    plain = F.lower(F.regexp_replace("text", "<[^>]*>", " "))
    words = texts.where("text is not null").select(F.explode(F.split(plain, r"[^\p{L}]+")).alias("word"))
    return words.where(F.length("word").between(1, LONGEST_WORD)).groupBy("word").agg(F.count("*").alias("n"))


def segment(name: str, counts: dict[str, int], total: int) -> list[str]:
    """The likeliest words of `name` under a unigram model (Viterbi); the fewest words among equals.

    An unseen word of k letters has the chance 10 / (total 10^k), a seen one its share.
    """
    best: list[tuple[float, int, int]] = [(0.0, 0, 0)]  # cost, words, start of the last one
    scale = math.log(max(2, total))
    for end in range(1, len(name) + 1):
        options = []
        for start in range(max(0, end - LONGEST_WORD), end):
            n = counts.get(name[start:end], 0)
            cost = scale - math.log(n) if n else scale + (end - start - 1) * math.log(10)
            options.append((best[start][0] + cost, best[start][1] + 1, start))
        best.append(min(options))
    out, end = [], len(name)
    while end:
        start = best[end][2]
        out.append(name[start:end])
        end = start
    return out[::-1]


def segmented(names: DataFrame, counts: DataFrame) -> DataFrame:
    """(name, words) of each row of `names` (distinct), with unigram counts `counts` (word, n).

    Every part of a name that is a word is found by a join, so the vocabulary may have any size; a name
    holds only the counts of its own parts.
    """
    total = counts.agg(F.sum("n")).first()[0] or 0
    letters = F.sequence(F.lit(1), F.length("name"))
    parts = (
        names.where(F.length("name") > 0)
        .select("name", F.explode(letters).alias("start"))
        .select("name", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start") + 1))).alias("size"))
        .select("name", F.substring("name", F.col("start"), F.col("size")).alias("word"))
        .distinct()
    )
    known = parts.join(counts, "word").groupBy("name").agg(F.collect_list(F.struct("word", "n")).alias("known"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                segment(name, {} if known is None else {r["word"]: r["n"] for r in known}, total)
                for name, known in zip(batch["name"], batch["known"], strict=True)
            ]
            yield pd.DataFrame({"name": batch["name"], "words": found})

    return names.join(known, "name", "left").select("name", "known").mapInPandas(run, "name string, words array<string>")


class NaiveBayes:
    """Multinomial naive Bayes over terms with add-one smoothing. Terms that no example has say nothing, and
    the prior is given, since the examples are chosen and their shares say nothing of the web."""

    def __init__(self, examples: Iterable[tuple[str, list[str]]], blocked_share: float = BLOCKED_SHARE):
        counts = {ALLOW: Counter(), BLOCK: Counter()}
        for verdict, terms in examples:
            counts[verdict].update(terms)
        terms = {t for c in counts.values() for t in c}
        if len(terms) > MAX_TERMS:
            raise ValueError(f"more than {MAX_TERMS} terms in the examples")
        sizes = {v: sum(c.values()) + len(terms) + 1 for v, c in counts.items()}
        self.prior = math.log(blocked_share / (1 - blocked_share))
        self.odds = {
            t: math.log((counts[BLOCK][t] + 1) / sizes[BLOCK]) - math.log((counts[ALLOW][t] + 1) / sizes[ALLOW]) for t in sorted(terms)
        }

    def score(self, terms: Iterable[str]) -> float:
        """Log-odds of block against allow."""
        return self.prior + sum(self.odds.get(t, 0.0) for t in terms)


def default_examples() -> list[tuple[str, list[str]]]:
    return [(verdict, name.split("-")) for verdict, names in EXAMPLES for name in names.split()]


def judge(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    examples: Sequence[tuple[str, list[str]]] | None = None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, words, score) of every row of `pages` (page_id, url).

    The longest fitting rule decides; where none fits, rule is null and naive Bayes over the words of the host and the path
    does: block if the log-odds (score) are positive. Runs of letters in the host, without the top-level domain, are split
    into words by the unigram counts of `texts` (text) and of the examples; runs of letters in the path are
    terms as they are. The classifier learns from `examples` (verdict, terms), by default a fixed list of site names.
    A null url or one without `://` has an empty host and path, fits no rule and has no words. Rows, also repeated
    ones or with a null page_id, are kept; an empty table gives an empty one.
    """
    spark = pages.sparkSession
    model = NaiveBayes(default_examples() if examples is None else examples)
    rows = pick(pages, page_id="page_id", url="url")
    host, path = parsed(F.col("url"))
    rows = rows.select("page_id", host.alias("host"), path.alias("path"))
    rows = rows.withColumn("match", matching_rule(F.col("host"), F.col("path"), rules))
    hosts = staged(rows.select("host").distinct().select("host", _names(F.col("host")).alias("names")), "hosts")
    taught = spark.createDataFrame([(t, 1) for _, terms in (examples or default_examples()) for t in terms], "word string, n long")
    counts = taught if texts is None else word_counts(texts).unionByName(taught)
    counts = staged(counts.groupBy("word").agg(F.sum("n").alias("n")), "words")
    own = hosts.select("host", F.posexplode("names").alias("place", "name"))
    split = segmented(own.select("name").distinct(), counts)
    of_host = (
        own.join(split, "name")
        .groupBy("host")
        .agg(F.sort_array(F.collect_list(F.struct("place", "words"))).alias("parts"))
        .select("host", F.flatten("parts.words").alias("words"))
    )
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        nb, letters = shared.value, re.compile(r"[^\W\d_]+")
        for batch in batches:
            words = [[] if w is None else list(w) for w in batch["words"]]
            scores = [nb.score([*w, *letters.findall(p.lower())]) for w, p in zip(words, batch["path"], strict=True)]
            batch["words"], batch["score"] = words, scores
            batch["verdict"] = [v if v is not None else BLOCK if s > 0 else ALLOW for v, s in zip(batch["verdict"], scores, strict=True)]
            yield batch

    joined = rows.join(of_host, "host", "left").select("page_id", "host", "path", "match.rule", "match.verdict", "words")
    kind = joined.schema["page_id"].dataType.simpleString()
    return joined.mapInPandas(
        run, f"page_id {kind}, host string, path string, rule string, verdict string, words array<string>, score double"
    )
