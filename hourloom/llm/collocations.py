"""Phrase collocations: candidates by Apriori, counted with double-array tries that numpy walks from all words at once."""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce
from itertools import islice

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from hourloom.llm.common import pick, staged

LEAST, LONGEST, SCALE, COVERED, TOP = 30, 4, 2_000_000, 80, 2_000
# What is broadcast at once: words of a vocabulary shard, phrases of a trie, bits of the set of frequent pairs.
VOCABULARY, TRIE, PAIR_BITS, CHUNK_BITS = 500_000, 500_000, 1 << 26, 1 << 16
# Different words and windows that a task holds before it passes their counts on, and rows that it passes on at once.
HELD_WORDS, BUFFER, ROWS = 400_000, 1 << 21, 1 << 16
SLICE = 1 << 19  # words that numpy looks at at once
ROW_WORDS, CHUNK_PHRASES, SALTS = 4_096, 4_096, 64  # words and counts in a row, and groups of tasks whose counts are summed first
BREAKS = bytes.maketrans(b"\t,;:!?\n\x0b\x0c\r", b" .........")
BREAK, UNKNOWN = -1, 0


def tokens(text: str | None) -> list[bytes]:
    """The words of a text, A-Z lower-cased, and b"." wherever a piece ends."""
    if not isinstance(text, str):
        return []
    return text.encode("utf-8", "surrogatepass").lower().translate(BREAKS).replace(b".", b" . ").split()


class DoubleArray:
    """A trie of phrases (rows of word numbers from 1, filled up with 0) as two arrays.

    The child of state s by label c is the slot base[s] + c if check has s there. Labels are the words of the phrases,
    the most used first, so that the children of a state lie close together; `accepts` has the phrase of a state or -1.
    """

    def __init__(self, phrases: np.ndarray):
        self.words, used = np.unique(phrases[phrases > 0], return_counts=True)
        self.labels = np.empty(len(self.words), np.int64)
        self.labels[np.argsort(-used, kind="stable")] = np.arange(1, len(used) + 1)
        size, (n, width) = len(self.words), phrases.shape
        label = np.where(phrases > 0, self.labels[np.searchsorted(self.words, np.maximum(phrases, 1)).clip(0, max(0, size - 1))], 0)
        # Nodes by depth: a node is its parent and the label that leads to it; node 0 is the root.
        at, ends, parents, steps, nodes = np.zeros(n, np.int64), np.full(n, 0), [], [], 1
        for k in range(width):
            rows = np.nonzero(label[:, k])[0]
            keys, number = np.unique(at[rows] * (size + 1) + label[rows, k], return_inverse=True)
            parents.append(keys // (size + 1))
            steps.append(keys % (size + 1))
            at[rows] = ends[rows] = nodes + number
            nodes += len(keys)
        parent, step = np.concatenate(parents), np.concatenate(steps)
        base = self._fit(parent, step, nodes, size)
        slots = np.concatenate([[0], base[parent] + step])
        length = int(max(slots.max(), base.max(initial=0))) + size + 1
        self.base, self.check, self.accepts = np.zeros(length, np.int32), np.full(length, -1, np.int32), np.full(length, -1, np.int32)
        self.base[slots] = base
        self.check[slots[1:]] = slots[parent]
        self.accepts[slots[ends]] = np.arange(n)
        self.size, self.depth = n, width

    @staticmethod
    def _fit(parent: np.ndarray, step: np.ndarray, nodes: int, size: int) -> np.ndarray:
        """A base for each node so that no two nodes share a slot; slots begin behind `size`, so that no base is negative."""
        order = np.lexsort((step, parent))
        parent, step = parent[order], step[order]
        starts = np.searchsorted(parent, np.arange(nodes + 1))
        counts, base = np.diff(starts), np.zeros(nodes, np.int64)
        taken = np.zeros(4 * (size + len(step)) + 64, bool)
        taken[: size + 1] = True
        end, low, rng = size + 1, size + 1, np.random.default_rng(0)
        for node in np.argsort(-counts, kind="stable"):
            if counts[node] < 2:
                break
            own = step[starts[node] : starts[node + 1]]
            while taken[low]:
                low += 1
            while max(low + 128, end) + 2 * size + 2 >= len(taken):
                taken = np.concatenate([taken, np.zeros(len(taken), bool)])
            spots = np.concatenate([np.arange(low, low + 128), rng.integers(low, max(low + 1, end), 128), [end + own[0]]])
            bases = np.maximum(spots - own[0], size + 1 - own[0])
            fits = ~taken[bases[:, None] + own].any(axis=1)
            base[node] = bases[np.argmax(fits)] if fits.any() else end
            taken[base[node] + own] = True
            end = max(end, int(base[node] + own[-1]) + 1)
        single = np.nonzero(counts == 1)[0]
        while np.count_nonzero(~taken) < len(single):
            taken = np.concatenate([taken, np.zeros(len(taken), bool)])
        base[single] = np.nonzero(~taken)[0][: len(single)] - step[starts[single]]
        return base

    def count(self, words: np.ndarray, starting: int) -> np.ndarray:
        """How often each phrase begins in the first `starting` of `words` (numbers; 0 and below are in no phrase), overlaps included."""
        total = np.zeros(self.size, np.int64)
        if not len(self.words) or not len(words):
            return total
        place = np.searchsorted(self.words, words).clip(0, len(self.words) - 1)
        label = np.where(self.words[place] == words, self.labels[place], 0)
        at, state = np.nonzero(label[:starting])[0], np.zeros(1, np.int64)
        for depth in range(self.depth):
            if depth:
                inside = at + depth < len(label)
                at, state = at[inside], state[inside]
            child = self.base[state] + label[at + depth]
            alive = (self.check[child] == state) & (label[at + depth] > 0)
            at, state = at[alive], child[alive].astype(np.int64)
            found = self.accepts[state]
            total += np.bincount(found[found >= 0], minlength=self.size)
        return total


def _word_counts(texts: DataFrame) -> DataFrame:
    """(lang, word, n): one row for each word and task, or more for a task that sees many."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[str, Counter] = {}

        def rows() -> Iterator[pd.DataFrame]:
            for lang, counter in seen.items():
                counter.pop(b".", None)
                entries = iter(counter.items())
                while some := list(islice(entries, ROWS)):
                    words = [word.decode("utf-8", "surrogatepass") for word, _ in some]
                    yield pd.DataFrame({"lang": lang, "word": words, "n": [n for _, n in some]})
            seen.clear()

        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                seen.setdefault(lang, Counter()).update(tokens(text))
                if sum(map(len, seen.values())) > HELD_WORDS:
                    yield from rows()
        yield from rows()

    counts = texts.mapInPandas(count, "lang string, word string, n long").repartition("lang", "word")
    return counts.groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _encoded(texts: DataFrame, words: DataFrame, n_words: int) -> DataFrame:
    """`words` column: each text as int32 word numbers, 0 for a word that is not listed, -1 where a piece ends.

    The list is broadcast in shards of at most VOCABULARY words; each shard is a pass over the texts, which fills in its words.
    """
    spark, shards = texts.sparkSession, max(1, -(-n_words // VOCABULARY))
    coded, ends = texts.withColumn("words", F.lit(None).cast("binary")), {b".": BREAK}
    for shard in range(shards):
        # Words travel as text, a few thousand in a row, which tasks make their dictionaries of.
        some = words.where((F.col("id") - 1) % shards == shard).groupBy("lang", F.floor(F.col("id") / ROW_WORDS).alias("row"))
        listed = some.agg(F.collect_list(F.struct("word", "id")).alias("l"))
        rows = listed.select("lang", F.array_join(F.col("l")["word"], "\n").alias("words"), F.col("l")["id"].alias("ids")).collect()
        known = spark.sparkContext.broadcast([(r.lang, r.words, np.array(r.ids, np.int32)) for r in rows])
        last = shard == shards - 1

        def encode(batches: Iterator[pd.DataFrame], known=known) -> Iterator[pd.DataFrame]:
            lists: dict[str, dict[bytes, int]] = {}
            for lang, joined, numbers in known.value:
                own = zip(joined.encode("utf-8", "surrogatepass").split(b"\n"), numbers.tolist(), strict=True)
                lists.setdefault(lang, dict(ends)).update(own)
            for batch in batches:
                out = []
                for lang, text, before in zip(batch["lang"], batch["text"], batch["words"], strict=True):
                    ids = lists.get(lang, ends)
                    own = np.array([ids.get(t, UNKNOWN) for t in tokens(text)], np.int32)
                    if before is not None:
                        own = np.where(own == UNKNOWN, np.frombuffer(before, np.int32), own)
                    out.append(own.tobytes())
                yield pd.DataFrame({"lang": batch["lang"], "text": batch["text"], "words": out})

        coded = coded.mapInPandas(encode, "lang string, text string, words binary")
        coded = staged(coded.select("words") if last else coded, "words")
        known.unpersist()
    return coded


def _slices(batch: pd.DataFrame, longest: int) -> Iterator[tuple[np.ndarray, int]]:
    """The words of all texts of a batch, with a break behind each text, in slices; phrases start at the first so many words of each."""
    end = np.array([BREAK], np.int32)
    parts = [x for words in batch["words"] for x in (np.frombuffer(words, np.int32), end)]
    words = np.concatenate(parts) if parts else end
    for at in range(0, len(words), SLICE):
        yield words[at : at + SLICE + longest - 1], min(SLICE, len(words) - at)


def _spot(first: np.ndarray, second: np.ndarray, bits: int) -> np.ndarray:
    """The bit of a pair in the set of frequent pairs."""
    mixed = first.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + second.astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)
    return (mixed ^ (mixed >> np.uint64(29))) % np.uint64(bits)


def _supported(coded: DataFrame, lengths: tuple[int, ...], pairs, least: int) -> DataFrame:
    """The windows of `lengths` listed words that tasks see `least` times together, as columns w1, w2, ...

    With `pairs`, a broadcast set of bits, only windows whose pairs are all in it are looked at: no frequent
    phrase is missed, since each part of a frequent phrase is frequent.
    """
    longest = max(lengths)

    def windows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        heads, tails, held = np.empty(BUFFER, np.int64), np.zeros(BUFFER, np.int64), 0
        known = None if pairs is None else _opened(pairs.value, PAIR_BITS)

        def rows() -> Iterator[pd.DataFrame]:
            head, tail = heads[:held], tails[:held]
            if longest > 2:
                order = np.lexsort((tail, head))
                head, tail = head[order], tail[order]
            else:
                head.sort()
            new = np.ones(held, bool)
            new[1:] = (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])
            first = np.nonzero(new)[0]
            counts = np.diff(np.append(first, held))
            for at in range(0, len(first), ROWS):
                some = first[at : at + ROWS]
                yield pd.DataFrame({"head": head[some], "tail": tail[some], "n": counts[at : at + ROWS]})

        for words, starting in (x for batch in batches for x in _slices(batch, longest)):
            good = words > 0
            link = good[:-1] & good[1:]
            if known is not None and len(words) > 1:
                spots = _spot(words[:-1], words[1:], PAIR_BITS)
                link &= (known[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8) & 1).astype(bool)
            run = link
            for k in range(2, longest + 1):
                if k > 2:
                    run = run[:-1] & link[k - 2 :]
                starts = np.nonzero(run[:starting])[0] if k in lengths else run[:0]
                for at in range(0, len(starts), ROWS):
                    some = starts[at : at + ROWS]
                    if held + len(some) > BUFFER:
                        yield from rows()
                        held = 0
                    here = slice(held, held + len(some))
                    heads[here] = (words[some].astype(np.int64) << 32) | words[some + 1]
                    if longest > 2:
                        tails[here] = words[some + 2].astype(np.int64) << 32
                        if k > 3:
                            tails[here] |= words[some + 3]
                    held += len(some)
        yield from rows()

    # A task's rows are all different already, so they are dealt out first and summed once.
    seen = coded.mapInPandas(windows, "head long, tail long, n long").repartition("head", "tail")
    found = seen.groupBy("head", "tail").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    halves = [F.shiftright(c, 32).cast("int") if high else F.col(c).bitwiseAND((1 << 31) - 1).cast("int") for c in ("head", "tail") for high in (True, False)]
    return found.select([half.alias(f"w{k + 1}") for k, half in enumerate(halves)])


def _pair_bits(pairs: DataFrame, bits: int):
    """The set of `pairs` as a broadcast array of `bits` bits, packed by chunks in tasks."""

    def spots(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spot = np.unique(_spot(batch["w1"].to_numpy(), batch["w2"].to_numpy(), bits).astype(np.int64))
            yield pd.DataFrame({"chunk": spot // CHUNK_BITS, "spot": spot % CHUNK_BITS})

    def pack(rows: pd.DataFrame) -> pd.DataFrame:
        chunk = np.zeros(CHUNK_BITS, bool)
        chunk[rows["spot"]] = True
        packed = zlib.compress(np.packbits(chunk, bitorder="little").tobytes(), 1)
        return pd.DataFrame({"chunk": rows["chunk"].iloc[:1], "bits": [packed]})

    chunks = pairs.mapInPandas(spots, "chunk long, spot long").distinct().groupBy("chunk").applyInPandas(pack, "chunk long, bits binary")
    rows = chunks.collect()  # at most bits / CHUNK_BITS rows, `bits` in all, and packed
    return pairs.sparkSession.sparkContext.broadcast([(row.chunk, bytes(row.bits)) for row in rows])


def _opened(packed: list[tuple[int, bytes]], bits: int) -> np.ndarray:
    """The broadcast set as an array of bytes."""
    size = CHUNK_BITS // 8
    whole = np.zeros(bits // 8, np.uint8)
    for chunk, data in packed:
        own = np.frombuffer(zlib.decompress(data), np.uint8)
        whole[chunk * size : chunk * size + len(own)] = own
    return whole


def _counted(coded: DataFrame, candidates: DataFrame, n: int, least: int) -> DataFrame:
    """(phrase, a) of the candidates (w1, ...) that occur `least` times: phrase is an array of word numbers.

    Candidates are dealt to tries of at most about TRIE phrases. Each trie is built in a task and broadcast alone; a task sums a trie's
    counts over its texts, and Spark sums the tasks' counts.
    """
    spark, shards = coded.sparkSession, max(1, -(-n // TRIE))
    names = [f"w{k + 1}" for k in range(LONGEST)]
    dealt = candidates.withColumn("shard", F.pmod(F.xxhash64(*names), F.lit(shards)).cast("int"))
    numbered = dealt.withColumn("no", F.row_number().over(Window.partitionBy("shard").orderBy(*names)) - 1)
    numbered = staged(numbered, "candidates")
    parts = []
    for shard in range(shards):
        arrays = numbered.where(F.col("shard") == shard).groupBy("shard").applyInPandas(_packed, "trie binary").collect()
        if not arrays:
            continue
        trie = spark.sparkContext.broadcast(bytes(arrays[0].trie))

        def count(batches: Iterator[pd.DataFrame], trie=trie, shard=shard) -> Iterator[pd.DataFrame]:
            walker, total = _unpacked(trie.value), 0
            for words, starting in (x for batch in batches for x in _slices(batch, LONGEST)):
                total = total + walker.count(words, starting)
            if not np.isscalar(total):
                salt = TaskContext.get().partitionId() % SALTS
                cuts = [total[at : at + CHUNK_PHRASES] for at in range(0, len(total), CHUNK_PHRASES)]
                some = [k for k, cut in enumerate(cuts) if cut.any()]
                yield pd.DataFrame({"shard": shard, "chunk": some, "salt": salt, "counts": [cuts[k].tobytes() for k in some]})

        parts.append(coded.mapInPandas(count, "shard int, chunk int, salt int, counts binary"))
    if not parts:
        return spark.createDataFrame([], "phrase array<int>, a long")
    # A task's counts travel as rows of CHUNK_PHRASES, summed first by groups of tasks and then over those.
    vectors = reduce(DataFrame.unionByName, parts).groupBy("shard", "chunk", "salt")
    vectors = vectors.applyInPandas(_summed, "shard int, chunk int, salt int, counts binary").groupBy("shard", "chunk")
    sums = vectors.applyInPandas(_numbered, "shard int, no int, a long").where(F.col("a") >= least)
    phrase = F.filter(F.array(*names), lambda w: w > 0)
    return numbered.join(sums, ["shard", "no"]).select(phrase.alias("phrase"), "a")


def _summed(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(counts, np.int64) for counts in rows["counts"])
    return rows.iloc[:1].assign(counts=[total.tobytes()])


def _numbered(rows: pd.DataFrame) -> pd.DataFrame:
    total = sum(np.frombuffer(counts, np.int64) for counts in rows["counts"])
    first = int(rows["chunk"].iloc[0]) * CHUNK_PHRASES
    return pd.DataFrame({"shard": rows["shard"].iloc[0], "no": first + np.arange(len(total)), "a": total})


def _packed(rows: pd.DataFrame) -> pd.DataFrame:
    phrases = rows.sort_values("no")[[f"w{k + 1}" for k in range(LONGEST)]].to_numpy(np.int32)
    trie = DoubleArray(phrases)
    head = np.array([len(trie.words), len(trie.base), trie.size, trie.depth], np.int32)
    arrays = (head, trie.words.astype(np.int32), trie.labels.astype(np.int32), trie.base, trie.check, trie.accepts)
    return pd.DataFrame({"trie": [zlib.compress(b"".join(a.tobytes() for a in arrays), 1)]})


def _unpacked(data: bytes) -> DoubleArray:
    trie, values = DoubleArray.__new__(DoubleArray), np.frombuffer(zlib.decompress(data), np.int32)
    n, slots, trie.size, trie.depth = (int(x) for x in values[:4])
    cuts = np.cumsum([4, n, n, slots, slots])
    _, trie.words, labels, trie.base, trie.check, trie.accepts = np.split(values, cuts)
    trie.labels = labels.astype(np.int64)
    return trie


def _scored(counts: DataFrame) -> DataFrame:
    """(phrase, a, l, r, score) of the phrases of two words or more in `counts` (phrase, a), by their lowest cut."""
    long = counts.where(F.size("phrase") > 1)
    cuts = long.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k")).select(
        "phrase", "a", "k", F.slice("phrase", F.lit(1), F.col("k")).alias("head"), F.expr("slice(phrase, k + 1, size(phrase))").alias("tail")
    )
    heads, tails = counts.toDF("head", "l"), counts.toDF("tail", "r")
    both = cuts.join(heads, "head").join(tails, "tail")
    exact = "cast({} as decimal(19,0))"
    score = F.expr(f"({SCALE}BD * {exact.format('a')}) div ({exact.format('l')} + {exact.format('r')})")
    least = both.groupBy("phrase", "a").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut"))
    return least.select("phrase", "a", "cut.l", "cut.r", "cut.score")


def _uncovered(scored: DataFrame, covered: int) -> DataFrame:
    """`scored` without phrases inside a longer one that has at least `covered` hundredths of their count."""
    inner = F.expr(
        "flatten(transform(sequence(2, size(phrase) - 1), k -> transform(sequence(1, size(phrase) - k + 1), i -> slice(phrase, i, k))))"
    )
    inside = scored.where(F.size("phrase") > 2).select(F.explode(inner).alias("phrase"), F.col("a").alias("outer"))
    most = inside.groupBy("phrase").agg(F.max("outer").alias("outer"))
    exact = "decimal(20,0)"
    kept = F.col("outer").isNull() | (F.col("outer").cast(exact) * 100 < F.col("a").cast(exact) * covered)
    return scored.join(most, "phrase", "left").where(kept).drop("outer")


def mine(docs: DataFrame, least: int = LEAST, covered: int = COVERED) -> DataFrame:
    """(lang, phrase, a, l, r, n, score) of all collocations of `docs` (text, lang).

    Texts are lower-cased (A-Z) and split at [.,;:!?] and line ends into pieces, pieces at blanks and tabs into words. A phrase of 2 to 4 words in one
    piece that occurs `least` times or more in its lang is a candidate; of its cuts into two parts the one of the lowest score
    floor(2000000 a / (l + r)) counts, ties the shortest head. Candidates inside a longer one that has `covered` hundredths of their count
    are left out. n is the number of words of the lang.

    Words are counted first; texts are then written as numbers of the words that are frequent, which every later
    pass reads. Pairs of frequent words, and windows all of whose pairs are frequent, become candidates if the tasks
    together see them often enough; all candidates are counted by tries.

    Null texts are empty, a null lang is `und`; empty and blank texts have no words, and a table without words gives no row. Very long texts are
    read whole; repeated rows count each time. Extra columns are ignored. Ties are all kept.
    """
    rows = pick(docs, text="text", lang="lang")
    texts = rows.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    words = staged(_word_counts(texts), "word-counts")
    totals = words.groupBy("lang").agg(F.sum("n").alias("n"))
    frequent = words.where(F.col("n") >= least)
    listed = staged(_listed(frequent), "vocabulary")
    n_words = listed.count()
    coded = _encoded(texts, listed, n_words)
    pairs = staged(_supported(coded, (2,), None, least), "pairs")
    bits = _pair_bits(pairs, PAIR_BITS)
    longer = staged(_supported(coded, tuple(range(3, LONGEST + 1)), bits, least), "windows")
    bits.unpersist()
    candidates = pairs.unionByName(longer)
    counted = _counted(coded, candidates, candidates.count(), least)
    single = listed.select(F.array("id").alias("phrase"), F.col("n").alias("a"))
    scored = staged(_scored(staged(counted.unionByName(single), "counts")), "scored")
    left = _uncovered(scored, covered)
    spelt = left.select("*", F.posexplode("phrase").alias("at", "id")).join(listed.select("id", "lang", "word"), "id")
    spelt = spelt.groupBy("phrase", "a", "l", "r", "score").agg(
        F.first("lang").alias("lang"), F.sort_array(F.collect_list(F.struct("at", "word"))).alias("spelt")
    )
    text = F.array_join(F.col("spelt")["word"], " ")
    return spelt.select("lang", text.alias("phrase"), "a", "l", "r", "score").join(totals, "lang").select(
        "lang", "phrase", "a", "l", "r", "n", "score"
    )


def _listed(frequent: DataFrame) -> DataFrame:
    """`frequent` (lang, word, n) with an int id from 1 that counts on through the tasks' parts."""
    at = staged(frequent.withColumn("at", F.monotonically_increasing_id()), "frequent")
    parts = at.groupBy(F.shiftright("at", 33).alias("part")).agg(F.count("*").alias("rows"))
    before = F.coalesce(F.sum("rows").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = parts.select("part", before.alias("before"))  # one row for each task
    place = F.col("before") + F.col("at").bitwiseAND((1 << 33) - 1) + 1
    return at.join(offsets, F.shiftright("at", 33) == F.col("part")).select("lang", "word", "n", place.cast("int").alias("id"))


def best(phrases: DataFrame, top: int = TOP) -> DataFrame:
    """The first `top` rows of each lang of `mine` by score and a, falling, then phrase; rank counts from 1."""
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = phrases.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
