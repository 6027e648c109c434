"""Language ID by hyperdimensional profiles."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hourloom.llm.common import pick

DIM, GRAM, MAX_LANGUAGES = 1024, 3, 2_000
UNKNOWN = "und"
KNOWN_GRAMS, SLICE = 20_000, 1_000_000
FOLDS, HELD_OUT = 3, 1

_tables: dict[str, np.ndarray] = {}


def _is_letter() -> np.ndarray:
    """For each code point, whether it is a letter."""
    if not _tables:
        _tables["letter"] = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _tables["letter"]


class Space:
    """Random vectors of +1 and -1 for letters, and the vectors that they give n-grams.

    The vector of an n-gram is the product of its letters' vectors, each turned by its distance from the end, so
    that order counts. A code point's vector depends on the code point alone, so all workers agree.
    """

    def __init__(self, dim: int, gram: int):
        self.dim, self.gram = dim, gram
        self.letters: dict[int, np.ndarray] = {}
        self.rows: dict[tuple, int] = {}
        self.vectors = np.empty((KNOWN_GRAMS, dim), np.float32)

    def letter(self, code: int) -> np.ndarray:
        if code not in self.letters:
            if len(self.letters) >= KNOWN_GRAMS:  # a cache only
                self.letters.clear()
            bits = np.random.default_rng([code, self.dim]).integers(0, 2, self.dim)
            self.letters[code] = (2 * bits - 1).astype(np.float32)
        return self.letters[code]

    def vector(self, grams: tuple[int, ...]) -> np.ndarray:
        out = self.letter(grams[-1])
        for turn, code in enumerate(reversed(grams[:-1]), start=1):
            out = out * np.roll(self.letter(code), turn)
        return out

    def grams(self, text: str):
        """(n-grams as rows of code points, counts) of a whole text, by slices; words have a mark (0) on both sides."""
        found = []
        low = text.lower()
        for at in range(0, len(low), SLICE):
            part = low[max(0, at - self.gram) : at + SLICE]
            codes = np.frombuffer(part.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
            codes = np.where(_is_letter()[codes], codes, 0)
            codes = np.concatenate(([0], codes, [0]))
            codes = codes[np.concatenate(([True], (codes[1:] != 0) | (codes[:-1] != 0)))]
            if len(codes) < self.gram or not codes.any():
                continue
            key = codes[: len(codes) - self.gram + 1].copy()
            for k in range(1, self.gram):
                key = (key << 21) | codes[k : len(codes) - self.gram + 1 + k]
            found.append(key)
        if not found:
            return np.empty(0, np.int64), np.empty(0, np.int64)
        return np.unique(np.concatenate(found), return_counts=True)

    def bundle(self, keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """The sum of the n-grams' vectors, each as often as it occurs."""
        total = np.zeros(self.dim)
        for at in range(0, len(keys), KNOWN_GRAMS // 2):
            some = keys[at : at + KNOWN_GRAMS // 2].tolist()
            if len(self.rows) + len(some) > KNOWN_GRAMS:  # a cache only
                self.rows.clear()
            known = self.rows
            for key in some:
                if key not in known:
                    codes = tuple((key >> (21 * k)) & 0x1FFFFF for k in reversed(range(self.gram)))
                    self.vectors[len(known)] = self.vector(codes)
                    known[key] = len(known)
            rows = np.fromiter((known[k] for k in some), np.int64, len(some))
            total += counts[at : at + len(some)].astype(np.float32) @ self.vectors[rows]
        return total


_spaces: dict[tuple[int, int], Space] = {}


def _space(dim: int, gram: int) -> Space:
    if (dim, gram) not in _spaces:
        _spaces[dim, gram] = Space(dim, gram)
    return _spaces[dim, gram]


def held_out(doc_id: Column, folds: int = FOLDS, fold: int = HELD_OUT) -> Column:
    """crc32 of the id as text, modulo `folds`, is `fold`; false for a null id."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def prototypes(docs: DataFrame, dim: int = DIM, gram: int = GRAM) -> dict[str, np.ndarray]:
    """The bundle of all texts of each language of `docs` (text, lang), as a unit vector.

    Every task sums its own rows and hands on one vector for each language; the sums meet by language and component.
    What reaches the driver is one vector for each language, at most 2,000 of them (more is a
    ValueError). Rows with a null text or language, and languages without a letter, teach nothing.
    """
    rows = pick(docs, text="text", lang="lang").where("text is not null and lang is not null")
    if rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")

    def learn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space, sums = _space(dim, gram), {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                parts = [space.grams(t) for t in texts]
                keys, back = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
                counts = np.bincount(back, np.concatenate([c for _, c in parts]), len(keys))
                sums[lang] = sums.get(lang, 0) + space.bundle(keys, counts)
        for lang, total in sums.items():
            yield pd.DataFrame({"lang": lang, "k": np.arange(dim), "v": np.rint(total).astype(np.int64)})

    summed = rows.mapInPandas(learn, "lang string, k int, v long").groupBy("lang", "k").agg(F.sum("v").alias("v"))
    found: dict[str, np.ndarray] = {}
    for lang, k, v in summed.where("v <> 0").collect():
        found.setdefault(lang, np.zeros(dim))[k] = v
    return {lang: v / np.linalg.norm(v) for lang, v in sorted(found.items())}


def predict(docs: DataFrame, known: dict[str, np.ndarray], dim: int = DIM, gram: int = GRAM) -> DataFrame:
    """(doc_id, lang_pred, score) of every row of `docs` (doc_id, text): the language of the highest cosine, and that
    cosine, not below 0. Ties go to the first language by name. A text that is null or has no letter is `und`
    with score 0, and so is any text if no language is known. Rows, also repeated ones, are kept."""
    rows = pick(docs, doc_id="doc_id", text="text")
    names = sorted(known)
    matrix = np.stack([known[n] for n in names]) if names else np.zeros((0, dim))
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        space = _space(dim, gram)
        names, matrix = shared.value
        for batch in batches:
            labels, scores = [], []
            for text in batch.pop("text"):
                label, score = UNKNOWN, 0.0
                keys, counts = space.grams(text or "")
                if len(keys) and names:
                    own = space.bundle(keys, counts)
                    size = np.linalg.norm(own)
                    cosines = matrix @ own / (size or 1.0)
                    best = int(np.argmax(cosines))
                    label, score = names[best], float(min(1.0, max(0.0, cosines[best])))
                labels.append(label)
                scores.append(score)
            batch["lang_pred"], batch["score"] = labels, scores
            yield batch

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score): learned on the rows that are not held out, predicted for all."""
    rows = pick(docs, doc_id="doc_id", text="text", lang="lang")
    out = predict(rows, prototypes(rows.where(~held_out(F.col("doc_id")))))
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
