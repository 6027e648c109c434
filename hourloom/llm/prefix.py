"""Token counts: the exact number of tokens of every prefix of a text, by dynamic programming."""

from __future__ import annotations

import re
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import pick
from hourloom.llm.pieces import BPE, SPACE, PieceTable

PARTS = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
KNOWN_PREFIXES, LONG_PART = 700_000, 64


class PrefixCounter:
    """Counts tokens of a BPE model at every prefix.

    The last piece of the encoding of a prefix is the one piece that ends there and is apart from the last
    piece of the encoding of what stands before it. Both and the count are kept for each prefix, so every
    prefix costs a few look-ups, no merge is ever run over the text, and words that begin alike share
    the prefixes they have in common.
    """

    def __init__(self, table: PieceTable):
        if table.kind != BPE or not table.splits_at_space:
            raise ValueError("prefix counts need a BPE model whose pieces hold spaces only in front")
        self.table = table
        self.endings = table.trie(backwards=True)
        self.known: dict[str, tuple[str, int]] = {}  # prefix of a part -> last piece, tokens

    def _last(self, part: str, end: int, before) -> tuple[str, int]:
        """Last piece and tokens of part[:end]; before(k) gives those of part[:k]."""
        found, node, at = [], self.endings, end
        while at:
            at -= 1
            node = node.get(part[at])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                found.append((at, piece))
        apart = self.table.apart
        for at, piece in reversed(found):
            if at == 0:
                return piece, 1
            last, count = before(at)
            if apart(last, piece):
                return piece, count + 1
        char = part[end - 1]  # no piece, so it merges with nothing
        return char, (before(end - 1)[1] if end > 1 else 0) + len(self.table.fallback(char))

    def last(self, part: str) -> tuple[str, int]:
        """Last piece and tokens of a part of a text."""
        known = self.known
        if len(part) > LONG_PART:
            return self._all(part)[-1]
        size = len(part) - 1
        while size and part[:size] not in known:
            size -= 1
        for end in range(size + 1, len(part) + 1):
            known[part[:end]] = self._last(part, end, lambda k: known[part[:k]])
        return known[part]

    def _all(self, part: str) -> list[tuple[str, int]]:
        states: list[tuple[str, int]] = []
        for end in range(1, len(part) + 1):
            states.append(self._last(part, end, lambda k: states[k - 1]))
        return states

    def marked(self, text: str) -> str:
        return (SPACE if self.table.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""

    def count(self, text: str) -> int:
        """Tokens of the whole text: the count at its last prefix."""
        if len(self.known) > KNOWN_PREFIXES:  # a cache only
            self.known.clear()
        get, last, total = self.known.get, self.last, 0
        for part in PARTS.findall(self.marked(text)):
            total += (get(part) or last(part))[1]
        return total

    def prefix_counts(self, text: str) -> np.ndarray:
        """Tokens of text[:k] for k = 0 .. len(text)."""
        out, before = [0] * (not self.table.dummy_prefix or not text), 0
        for part in PARTS.findall(self.marked(text)):
            counts = [before + c for _, c in self._all(part)]
            out.extend(counts)
            before = counts[-1]
        if text and self.table.dummy_prefix:
            out[0] = 0  # the prefix mark alone stands for the empty text
        return np.asarray(out, dtype=np.int32)


_counters: dict[bytes, PrefixCounter] = {}


def _counter(model: bytes) -> PrefixCounter:
    """One counter for each model and Python worker, so that its caches outlive a task."""
    key = model[-4096:] + len(model).to_bytes(8, "big")
    if key not in _counters:
        _counters[key] = PrefixCounter(PieceTable.parse(model))
    return _counters[key]


def token_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) of every row of `docs` (doc_id, text), for the model at `model_path`.

    Counts equal the model's own library on the whole text. A null text counts as empty: no bytes, no
    tokens. Repeated rows are kept; doc_id may be null; an empty table gives an empty one. The model
    file is read on the driver and broadcast; its size does not depend on the data.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(model.value)
        for batch in batches:
            batch["n_tokens"] = np.fromiter(map(counter.count, batch.pop("text")), np.int64, len(batch))
            yield batch

    text = F.coalesce("text", F.lit(""))
    rows = pick(docs, doc_id="doc_id", text="text").select("doc_id", F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    return rows.mapInPandas(count, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, n_bytes long, n_tokens long")


def prefix_counts(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text, counts) with counts[k] the tokens of the first k characters, to be stored and asked later.

    Nulls and repeats are treated as in `token_counts`; the counts of a null text are [0].
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counter = _counter(model.value)
        for batch in batches:
            batch["counts"] = [counter.prefix_counts(t or "") for t in batch["text"]]
            yield batch

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(count, f"doc_id {kind}, text string, counts array<int>")


def longest_within(counts: Column, budget: Column | int) -> Column:
    """Characters of the longest prefix of at most `budget` tokens, from stored counts; no text is read.

    A longer prefix may have fewer tokens than a shorter one, so the last fitting place is wanted.
    """
    fits = F.transform(counts, lambda c, k: F.when(c <= budget, k))
    return F.array_max(fits)


def truncated(df: DataFrame, budget: int) -> DataFrame:
    """`prefix_counts` rows with text cut to its longest prefix of at most `budget` tokens, and n_tokens of it."""
    size = longest_within(F.col("counts"), budget)
    return df.select("doc_id", F.substring("text", F.lit(1), size).alias("text"), F.get("counts", size).alias("n_tokens"))
