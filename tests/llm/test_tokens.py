from __future__ import annotations

import hashlib
import random
from itertools import product

import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F

from hourloom.llm import prefix, transducer
from hourloom.llm.pieces import BYTE, NORMAL, UNIGRAM, UNKNOWN, PieceTable
from tests.llm.helpers import AWKWARD, DOC

PATH = public_tokenizers.path("piece_bpe_32k.model")
BITS = [" ", "  ", "\n", "a", "b", "the", "▁", "é", "ß", "😀", "𐍈", "\x00", "<s>", "0", "1", "日", "ing", "\t", "Ω", "́", "###"]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def pieces():
    with open(PATH, "rb") as f:
        return PieceTable.parse(f.read())


def random_texts(n, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(BITS, k=rng.randint(0, 30))) for _ in range(n)] + ["", " ", "a" * 500, " " * 300, "ab" * 400]


def test_every_prefix_count_is_the_librarys(library, pieces):
    counter = prefix.PrefixCounter(pieces)
    for text in random_texts(300):
        want = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert counter.prefix_counts(text).tolist() == want
        assert counter.count(text) == want[-1]


def test_shortest_paths_are_the_librarys_encoding(library, pieces):
    machine = transducer.Transducer(pieces)
    for text in random_texts(500):
        ids = library.encode(text)
        assert machine.encode(text).tolist() == ids
        assert machine.decode(ids) == library.decode(ids) == text.replace("▁", " ")
        assert machine.there_and_back(text)[1] == machine.decode(ids)


def test_unigram_shortest_path_has_the_best_score():
    scores = {"▁": -2.0, "a": -2.5, "b": -2.4, "ab": -3.9, "ba": -3.1, "▁a": -3.0, "aba": -6.5, "▁ab": -6.0}
    table = PieceTable([("<unk>", 0.0, UNKNOWN), *[(p, s, NORMAL) for p, s in scores.items()]], UNIGRAM)
    machine = transducer.Transducer(table)

    def best(text):
        if not text:
            return 0.0
        ends = [k for k in range(1, 4) if text[:k] in scores] or [0]
        return max(scores[text[:k]] + best(text[k:]) for k in ends) if ends[0] else float("-inf")

    for n in range(1, 7):
        for text in map("".join, product("ab", repeat=n)):
            ids = machine.encode(text).tolist()
            assert "".join(table.names[k] for k in ids) == "▁" + text
            assert abs(sum(table.scores[table.names[k]] for k in ids) - best("▁" + text)) < 1e-9


def test_bytes_stand_for_what_is_no_piece():
    table = PieceTable([("<unk>", 0.0, UNKNOWN), ("a", -1.0, NORMAL), ("▁", -2.0, NORMAL), *[(f"<0x{b:02X}>", 0.0, BYTE) for b in range(256)]])
    machine = transducer.Transducer(table)
    assert [table.names[k] for k in machine.encode("aé")] == ["▁", "a", "<0xC3>", "<0xA9>"]
    assert machine.decode(machine.encode("aé 😀")) == "aé 😀"
    assert machine.decode([3 + 0xC3]) == "�"


def test_unsupported_models_are_refused():
    with pytest.raises(ValueError):
        PieceTable([("x", 0.0, 4)])


def test_token_counts_of_awkward_rows(spark, library):
    got = prefix.token_counts(spark.createDataFrame(AWKWARD, DOC), PATH).collect()
    want = [(str(r[0]), len((r[1] or "").encode()), len(library.encode(r[1] or ""))) for r in AWKWARD]
    assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens) for r in got) == sorted(want)
    assert prefix.token_counts(spark.createDataFrame([], DOC), PATH).count() == 0


def test_budgets_from_stored_counts(spark, library):
    rows = [(k, t, None, None, None, 0) for k, t in enumerate(random_texts(40))]
    for r in prefix.truncated(prefix.prefix_counts(spark.createDataFrame(rows, DOC), PATH), 7).collect():
        text = rows[r.doc_id][1]
        fits = [k for k in range(len(text) + 1) if len(library.encode(text[:k])) <= 7]
        assert r.text == text[: fits[-1]] and r.n_tokens == len(library.encode(r.text)) <= 7
    empty = prefix.prefix_counts(spark.createDataFrame(AWKWARD[:2], DOC), PATH)
    assert [r.counts for r in empty.collect()] == [[0], [0]]
    assert empty.select(prefix.longest_within(F.col("counts"), 0).alias("k")).first().k == 0


def test_encoding_of_awkward_rows_and_back(spark, library):
    encoded = transducer.encode(spark.createDataFrame(AWKWARD, DOC), PATH)
    got = sorted((str(r.doc_id), r.n_ids, r.ids, r.decoded_sha256) for r in encoded.collect())
    want = [
        (str(r[0]), len(ids := library.encode(r[1] or "")), ids, hashlib.sha256(library.decode(ids).encode()).hexdigest()) for r in AWKWARD
    ]
    assert got == sorted(want)
    back = transducer.decode(encoded, PATH).collect()
    assert sorted((str(r.doc_id), r.text) for r in back) == sorted((str(r[0]), (r[1] or "").replace("▁", " ")) for r in AWKWARD)
    assert transducer.encode(spark.createDataFrame([], DOC), PATH).count() == 0
