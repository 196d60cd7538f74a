import random

import public_tokenizers
import pytest
from llm.docs_of import ODD, clashing, docs_of
from tokenizers import Tokenizer

from keyflow.llm import bpe

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_automaton_equals_the_library(library):
    machine, rng = bpe.automaton(PATH), random.Random(7)
    bits = [" ", "  ", "\n", "a", "b", "the", "ing", "'s", "1", "é", "́", "²", "日", "౜", " ", "-", "<|endoftext|>"]
    texts = ["".join(rng.choices(bits, k=rng.randint(0, 40))) for _ in range(2000)] + ["a" * 3000, "ab" * 999, ""]
    for text, found in zip(texts, library.encode_batch(texts, add_special_tokens=False), strict=True):
        ids = list(memoryview(machine.encode(text)).cast("i")) if text else []
        assert ids == found.ids
        assert machine.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_every_merge_makes_a_state():
    machine = bpe.automaton(PATH)
    assert len(machine.born) == 256 + machine.steps


def test_rows(spark, library):
    docs = clashing(docs_of(spark, ODD))
    found = bpe.decode(bpe.encode(docs, PATH), PATH).collect()
    assert sorted(str((r.doc_id, r.text)) for r in found) == sorted(str((i, t or "")) for i, t in ODD)
    for row in found:
        assert row.ids == library.encode(row.text, add_special_tokens=False).ids
    assert bpe.decode(bpe.encode(docs.limit(0), PATH), PATH).count() == 0
    empty = [r for r in bpe.digests(bpe.decode(bpe.encode(docs, PATH), PATH)).collect() if r.doc_id == 2][0]
    assert empty.n_tokens == 0 and empty.ids_sha256 == empty.decoded_sha256


def test_bytes_that_are_no_text(spark):
    rows = spark.createDataFrame([(1, [255, 128]), (2, [10**6]), (3, None)], "doc_id long, ids array<int>")
    found = {r.doc_id: r.text for r in bpe.decode(rows, PATH).collect()}
    assert set(found[1]) == {"�"} or found[1]
    assert found[2] == "" and found[3] == ""


def test_a_word_of_some_megabytes(spark, library):
    """Time grows with the length; the library itself is slow there, so only what is decoded is compared."""
    text = "abcxyz" * 600_000
    found = bpe.decode(bpe.encode(docs_of(spark, [(1, text), (2, "é" * 5000)]), PATH), PATH).collect()
    assert {r.doc_id: r.text for r in found} == {1: text, 2: "é" * 5000}
    assert [r.ids for r in found if r.doc_id == 2] == [library.encode("é" * 5000, add_special_tokens=False).ids]


@pytest.mark.parametrize("piece", [1, 3, 1 << 20])
def test_labels_are_gathered_in_pieces(monkeypatch, piece):
    import numpy as np

    monkeypatch.setattr(bpe, "PIECE_IDS", piece)
    labels = bpe.Labels({0: b"a", 1: "é".encode()[:1], 2: "é".encode()[1:], 5: b"xyz"})
    rows = [[0, 1, 2], [], [1], [5, 5, 5, 5, 9, -1, 0], [1, 2, 1, 2, 3]]
    offsets = np.concatenate([[0], np.cumsum([len(row) for row in rows])])
    ids = np.array([x for row in rows for x in row], np.int32)
    assert labels.texts(ids, offsets) == ["aé", "", "\ufffd", "xyzxyzxyzxyza", "éé"]


def test_a_word_is_kept_once(library):
    machine = bpe.Automaton(PATH)
    text = "one two, two three's  four\tfive 日本 six"
    assert list(memoryview(machine.encode(text)).cast("i")) == library.encode(text, add_special_tokens=False).ids
    plain = "a few more words and other ones"
    assert list(memoryview(machine.encode(plain)).cast("i")) == library.encode(plain, add_special_tokens=False).ids
    assert {*plain.split()[1:]} <= {*machine.spaced} and not {" " + word for word in plain.split()[1:]} & {*machine.words}
