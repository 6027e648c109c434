"""SentencePiece encoding and decoding as the shortest path through a weighted finite-state transducer."""

from __future__ import annotations

import hashlib
import re
from array import array
from collections.abc import Iterator
from pathlib import Path

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from hourloom.llm.common import pick
from hourloom.llm.pieces import BPE, BYTE, CONTROL, SPACE, PieceTable

# What a worker remembers while a task runs, by its size in memory: encodings of parts, and which pieces may stand side by side.
KNOWN_BYTES, KNOWN_PAIRS, LONG_PART = 64_000_000, 300_000, 64
PENALTY = 10.0  # of a character that is no piece, below the worst piece of a unigram model


class Transducer:
    """Normaliser, pieces and byte fallback compiled into one machine over characters.

    The normaliser has one state: it writes a space mark before the first character and for every space, and
    copies all others. The piece machine is a trie whose leaves write a piece's id and return to a start state;
    a character that is no piece writes its byte ids. A unigram model has one start state and the weight
    -score on each leaf. A BPE model's start states remember the piece just written, and the arc into the
    next piece exists (weight 0, else infinite) only if the two are apart, see `PieceTable.apart`. A path
    of finite weight is then the BPE encoding of what it has read, so the composition with an input,
    which is done lazily, reaches one state in each place, as it does for a unigram model. A BPE state is the number of
    the piece; encodings of whole parts are remembered up to KNOWN_BYTES, those of their places are not.
    """

    def __init__(self, table: PieceTable):
        self.table = table
        self.endings = table.trie(backwards=True)
        self.worst = -min(table.scores.values(), default=0.0) + PENALTY
        self.part = re.compile(f"{SPACE}+[^{SPACE}]*|[^{SPACE}]+" if table.splits_at_space else "(?s).+")
        # part -> ids as 32-bit numbers; when the younger are too many they replace the older
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.known_bytes = 0
        self.allowed: dict[int, bool] = {}  # state * states + piece -> whether the arc exists
        self.numbers = dict(table.ids)  # piece, or character that is none -> its state
        self.pieces = list(table.names)
        self.numbered = self._numbered(self.endings) if table.kind == BPE else {}
        assert table.longest <= LONG_PART, "pieces are short"
        self.written = [
            b"" if kind == CONTROL else bytes([int(name[3:5], 16)]) if kind == BYTE else name.replace(SPACE, " ").encode()
            for name, kind in zip(table.names, table.kinds, strict=True)
        ]

    def _numbered(self, node: dict) -> dict:
        """The trie with the numbers of its pieces."""
        return {char: self.numbers[below] if char == "" else self._numbered(below) for char, below in node.items()}

    def normalised(self, text: str) -> str:
        return (SPACE if self.table.dummy_prefix else "") + text.replace(" ", SPACE) if text else ""

    def _relax(self, text: str, end: int, before) -> tuple[float, str, int]:
        """The least weight with which text[:end] is read, over all arcs that end there; before(k) is that of text[:k]."""
        arcs, node, at = [], self.endings, end
        while at:
            at -= 1
            node = node.get(text[at])
            if node is None:
                break
            piece = node.get("")
            if piece is not None:
                arcs.append((at, piece))
        apart, scores = self.table.apart, self.table.scores
        if self.table.kind == BPE:
            for at, piece in reversed(arcs):
                if at == 0 or apart(before(at)[1], piece):
                    return 0.0, piece, at
            return 0.0, text[end - 1], end - 1
        best = None
        for at, piece in arcs:
            weight = (before(at)[0] if at else 0.0) - scores[piece]
            if best is None or weight < best[0]:
                best = weight, piece, at
        if not arcs or arcs[0][0] != end - 1:
            weight = (before(end - 1)[0] if end > 1 else 0.0) + self.worst
            if best is None or weight < best[0]:
                best = weight, text[end - 1], end - 1
        return best

    def _ids(self, piece: str) -> list[int]:
        number = self.table.ids.get(piece)
        return self.table.fallback(piece) if number is None else [number]

    def shortest(self, text: str) -> bytes:
        """Ids (32-bit numbers) on the shortest path of the normalised text through the composed machine."""
        if self.table.kind == BPE:
            return self._one_state(text)
        states: list[tuple[float, str, int]] = []
        for end in range(1, len(text) + 1):
            states.append(self._relax(text, end, lambda k: states[k - 1]))
        out, at = array("i"), len(text)
        while at:
            _, piece, at = states[at - 1]
            out.extend(reversed(self._ids(piece)))
        out.reverse()
        return out.tobytes()

    def _arc(self, state: int, piece: int) -> bool:
        """Whether a path that has written `state` last may write `piece`; remembered."""
        if len(self.allowed) >= KNOWN_PAIRS:
            self.allowed.clear()
        table, name = self.table, self.pieces
        both = table._meet(table.merges(name[state]), table.merges(name[piece]))
        self.allowed[state << 32 | piece] = both
        return both

    def _reach(self, text: str, end: int, states: list[int], starts: list[int]) -> int:
        """The one state in which a BPE machine has read text[:end]: the longest piece whose arc exists. Places that arcs
        come from are worked out when they are asked for (-1: not yet); most never are."""
        node, arcs = self.numbered, []
        for char in text[end - 1 :: -1] if end <= LONG_PART else text[end - 1 : end - LONG_PART - 1 : -1]:
            node = node.get(char)
            if node is None:
                break
            arcs.append(node.get(""))
        at, allowed = end - len(arcs), self.allowed
        for piece in reversed(arcs):
            if piece is not None:
                if not at:
                    break
                before = states[at]
                if before < 0:
                    before = self._reach(text, at, states, starts)
                known = allowed.get(before << 32 | piece)
                if known or (known is None and self._arc(before, piece)):
                    break
            at += 1
        else:  # a character that is no piece, or that no piece ends with
            at, char = end - 1, text[end - 1]
            piece = self.numbers.get(char)
            if piece is None:
                piece = self.numbers[char] = len(self.pieces)
                self.pieces.append(char)
        states[end], starts[end] = piece, at
        return piece

    def _one_state(self, text: str) -> bytes:
        """`shortest` for a BPE model."""
        size, own = len(text), len(self.table.names)
        states, starts = [-1] * (size + 1), [0] * (size + 1)
        if size > LONG_PART:  # in order, so that no place asks for a long chain of others
            for end in range(1, size + 1):
                self._reach(text, end, states, starts)
        out, end = array("i"), size
        while end:
            piece = states[end]
            if piece < 0:
                piece = self._reach(text, end, states, starts)
            if piece < own:
                out.append(piece)
            else:
                out.extend(reversed(self.table.fallback(self.pieces[piece])))
            end = starts[end]
        out.reverse()
        return out.tobytes()

    def forget(self) -> None:
        """Drop what was remembered; workers outlive a task, and later stages need the memory."""
        self.known, self.older, self.known_bytes = {}, {}, 0
        self.allowed.clear()
        self.numbers = dict(self.table.ids)
        del self.pieces[len(self.table.names) :]

    def _part(self, part: str) -> bytes:
        ids = self.older.get(part) or self.shortest(part)
        if len(part) <= LONG_PART:
            self.known[part] = ids
            self.known_bytes += 190 + len(part) + len(ids)
        return ids

    def there_and_back(self, text: str) -> tuple[np.ndarray, str]:
        """The ids of a text, and the text that they decode to. Parts are encoded one by one."""
        get, make = self.known.get, self._part
        if self.known_bytes >= KNOWN_BYTES:
            self.known, self.older, self.known_bytes = {}, self.known, 0
            get = self.known.get
        parts = [get(p) or make(p) for p in self.part.findall(self.normalised(text))]
        ids = np.frombuffer(b"".join(parts), np.int32)
        return ids, self.decode(ids.tolist())

    def encode(self, text: str) -> np.ndarray:
        return self.there_and_back(text)[0]

    def _text(self, raw: bytes) -> str:
        if self.table.dummy_prefix and raw[:1] == b" ":
            raw = raw[1:]
        return raw.decode("utf-8", "replace")

    def decode(self, ids) -> str:
        """The text of a sequence of ids; bytes that are no UTF-8 become U+FFFD, other ids raise IndexError."""
        return self._text(b"".join([self.written[k] for k in ids]))


_machines: dict[bytes, Transducer] = {}


def _machine(model: bytes) -> Transducer:
    """One machine for each model and Python worker: compiling it takes longer than many a task."""
    key = model[-4096:] + len(model).to_bytes(8, "big")
    if key not in _machines:
        _machines[key] = Transducer(PieceTable.parse(model))
    return _machines[key]


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, n_ids, ids, decoded_sha256) of every row of `docs` (doc_id, text).

    ids is the encoding of the whole text without begin or end marks; decoded_sha256 is the hash of the text that
    decoding gives back. A null text counts as empty and has no ids. Repeated rows and null doc_ids
    are kept; an empty table gives an empty one. The model file is read on the driver and broadcast.
    """
    model = docs.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = _machine(model.value)
        try:
            for batch in batches:
                for k in range(0, len(batch), 500):
                    part = batch.iloc[k : k + 500]
                    both = [machine.there_and_back(t or "") for t in part["text"]]
                    yield pd.DataFrame(
                        {
                            "doc_id": part["doc_id"],
                            "n_ids": [len(ids) for ids, _ in both],
                            "ids": [ids for ids, _ in both],
                            "decoded_sha256": [hashlib.sha256(back.encode()).hexdigest() for _, back in both],
                        }
                    )
        finally:
            machine.forget()

    rows = pick(docs, doc_id="doc_id", text="text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInPandas(run, f"doc_id {kind}, n_ids long, ids array<int>, decoded_sha256 string")


def decode(encoded: DataFrame, model_path: str) -> DataFrame:
    """(doc_id, text) of rows with `doc_id` and `ids`; null ids give a null text."""
    model = encoded.sparkSession.sparkContext.broadcast(Path(model_path).read_bytes())

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        machine = _machine(model.value)
        for batch in batches:
            batch["text"] = [None if x is None else machine.decode(x.tolist()) for x in batch.pop("ids")]
            yield batch

    rows = pick(encoded, doc_id="doc_id", ids="ids")
    return rows.mapInPandas(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")
