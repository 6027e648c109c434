"""The piece table of a sentencepiece model file, and which pieces may stand side by side."""

from __future__ import annotations

import struct
from functools import cached_property

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNIGRAM, BPE = 1, 2


def _fields(data: bytes):
    """(number, value) of each field of a protocol-buffer message; values are ints or bytes."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        number, kind = key >> 3, key & 7
        if kind == 0:
            yield number, varint()
        else:
            size = {1: 8, 5: 4}.get(kind) or varint()
            yield number, data[at : at + size]
            at += size


class PieceTable:
    """Pieces of a BPE or unigram model with their ids and scores.

    Only what the operators implement exactly is accepted: an identity normaliser that keeps white space
    and writes it as U+2581, and no user-defined or unused pieces. Anything else is a ValueError.
    """

    def __init__(self, pieces: list[tuple[str, float, int]], kind: int = BPE, dummy_prefix: bool = True):
        if any(k in (USER_DEFINED, UNUSED) for _, _, k in pieces):
            raise ValueError("user-defined and unused pieces are not supported")
        self.kind, self.dummy_prefix = kind, dummy_prefix
        self.names = [p for p, _, _ in pieces]
        self.kinds = [k for _, _, k in pieces]
        self.ids = {p: n for n, (p, _, k) in enumerate(pieces) if k == NORMAL}
        self.scores = {p: s for p, s, k in pieces if k == NORMAL}
        self.byte_ids = {int(p[3:5], 16): n for n, (p, _, k) in enumerate(pieces) if k == BYTE}
        self.unknown = next((n for n, k in enumerate(self.kinds) if k == UNKNOWN), 0)
        self.longest = max(map(len, self.ids), default=1)
        self._merges: dict[str, tuple | None] = {}
        self.decided: dict[tuple[str, str], bool] = {}

    @classmethod
    def parse(cls, data: bytes) -> PieceTable:
        pieces, trainer, normaliser = [], {}, {}
        for number, value in _fields(data):
            if number == 1:
                own = dict(_fields(value))
                score = struct.unpack("<f", own[2])[0] if 2 in own else 0.0
                pieces.append((own[1].decode(), score, own.get(3, NORMAL)))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3, UNIGRAM) not in (UNIGRAM, BPE):
            raise ValueError("only BPE and unigram models are supported")
        if normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1) or trainer.get(24):
            raise ValueError("only the identity normaliser that keeps white space is supported")
        return cls(pieces, trainer.get(3, UNIGRAM), bool(normaliser.get(3, 1)))

    @cached_property
    def splits_at_space(self) -> bool:
        """True if no piece has a space mark behind another character: then no piece crosses from one run
        of spaces and what follows it to the next, and each such part is encoded by itself."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.ids)

    def trie(self, backwards: bool = False) -> dict:
        """Nested dicts by character, from the front or the end, over the pieces that an encoding can hold;
        the key "" of a node names the piece that ends there."""
        root: dict = {}
        for piece in self.ids:
            if self.kind == UNIGRAM or self.merges(piece) is not None:
                node = root
                for char in reversed(piece) if backwards else piece:
                    node = node.setdefault(char, {})
                node[""] = piece
        return root

    def fallback(self, char: str) -> list[int]:
        """Ids of a character that is no piece: its bytes, or the unknown piece."""
        if not self.byte_ids:
            return [self.unknown]
        return [self.byte_ids[b] for b in char.encode("utf-8", "surrogatepass")]

    def merges(self, piece: str) -> tuple | None:
        """How BPE builds `piece` from its characters: (score, first, last symbol after it) of each merge.

        None if BPE ends in other symbols than the piece itself, so that no encoding holds the piece.
        """
        if piece not in self._merges:
            parts, steps = list(piece), []
            while len(parts) > 1:
                best = None
                for k in range(len(parts) - 1):
                    score = self.scores.get(parts[k] + parts[k + 1])
                    if score is not None and (best is None or score > best[0]):
                        best = score, k
                if best is None:
                    break
                k = best[1]
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
                steps.append((best[0], parts[0], parts[-1]))
            self._merges[piece] = ((None, piece[0], piece[-1]), *steps) if len(parts) == 1 else None
        return self._merges[piece]

    def apart(self, left: str, right: str) -> bool:
        """True if BPE encodes left + right as exactly these two pieces.

        BPE always takes the best merge, the leftmost among equals. So it works through the merges of both
        pieces in turn, best first, until the symbols that meet at the border would merge before the
        next of them. A sequence of pieces is the encoding of its text exactly if all its neighbours
        are apart: before the first merge across a border, each pair of neighbours goes through the
        same merges as it does alone.
        """
        try:
            return self.decided[left, right]
        except KeyError:
            if len(self.decided) >= 1_000_000:  # a cache only
                self.decided.clear()
            known = self.decided[left, right] = self._meet(self.merges(left), self.merges(right))
            return known

    def _meet(self, left: tuple | None, right: tuple | None) -> bool:
        if left is None or right is None:
            return False
        scores, i, j = self.scores, 0, 0
        while True:
            mine = left[i + 1][0] if i + 1 < len(left) else None
            other = right[j + 1][0] if j + 1 < len(right) else None
            across = scores.get(left[i][2] + right[j][1])
            if across is not None and (mine is None or across > mine) and (other is None or across >= other):
                return False
            if mine is None and other is None:
                return True
            if other is None or (mine is not None and mine >= other):
                i += 1
            else:
                j += 1
