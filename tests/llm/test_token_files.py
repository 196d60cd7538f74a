import string
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.parquet as pq
from llm.docs_of import ODD, clashing, docs_of
from tokenizers import Tokenizer

from keyflow.llm import token_files

PATH = public_tokenizers.path("word_bpe_49k.json")


def test_round_trip(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    rows = ODD + [(n, f"Doc {n}, it's the NEXT  one... {'word ' * (n % 30)}") for n in range(100, 300)]
    path = str(tmp_path / "tokens")
    token_files.write(clashing(docs_of(spark, rows)), PATH, path)
    found = token_files.read_tokens(spark, path).orderBy("start").collect()
    assert len(found) == len(rows)
    want = {}
    for doc_id, text in rows:
        want.setdefault(doc_id, []).append(library.encode(text or "", add_special_tokens=False).ids + [1])
    start, before = 0, None
    for row in found:
        assert row.start == start and row.n_tokens == len(row.ids)
        assert row.ids in want[row.doc_id]
        assert before is None or row.doc_id >= before
        start, before = start + row.n_tokens, row.doc_id
    sums = {(r.doc_id, r.start): r for r in token_files.digests(token_files.read_tokens(spark, path)).collect()}
    for row in found:
        assert sums[row.doc_id, row.start].ids_crc32 == zlib.crc32(np.array(row.ids, "<u4").tobytes())
    places = {(r.doc_id, r.start, r.n_tokens) for r in token_files.read_metadata(spark, path).collect()}
    assert places == {(r.doc_id, r.start, r.n_tokens) for r in found}


def test_files_have_the_promised_encodings(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(docs_of(spark, [(n, f"some words for row {n}") for n in range(2000)]), PATH, path)
    part = next(p for p in sorted((tmp_path / "tokens").glob("*.parquet")) if pq.read_metadata(p).num_rows > 50)
    group = pq.read_metadata(part).row_group(0)
    columns = {group.column(i).path_in_schema: group.column(i) for i in range(group.num_columns)}
    assert any("DICTIONARY" in x for x in columns["ids.list.element"].encodings)
    assert "DELTA_BINARY_PACKED" in columns["place"].encodings
    assert all(column.has_offset_index for column in columns.values())


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "tokens")
    token_files.write(docs_of(spark, ODD).limit(0), PATH, path)
    assert token_files.read_tokens(spark, path).count() == 0


def test_words_of_latin_letters_and_their_marks():
    library, machine = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    letters = [chr(c) for c in range(0xC0, 0x100)] + list("abcXYZ")
    rng = np.random.default_rng(1)
    words = letters + ["".join(rng.choice(letters, rng.integers(1, 12))) + mark for mark in ("", "", ".", ",", "...", "-") for _ in range(400)]
    words += ["Straße", "ÉTÉ,", "naïve.", "é", "É́", "ŷes", "ĲSSEL", "İstanbul", "ΣΑΣ", "×", "÷a", "a" * 5000, "é" * 3000 + "."]
    for word, found in zip(words, machine.encode(words), strict=True):
        assert np.frombuffer(found, "<i4").tolist() == library.encode(word, add_special_tokens=False).ids, word
    text = " ".join(words)
    assert np.frombuffer(machine.encode([text])[0], "<i4").tolist() == library.encode(text, add_special_tokens=False).ids


def test_starts_hold_under_a_limit_of_rows_per_file(spark, tmp_path):
    path, setting = str(tmp_path / "tokens"), "spark.sql.files.maxRecordsPerFile"
    spark.conf.set(setting, "7")
    try:
        token_files.write(docs_of(spark, [(n, "word " * (n % 5)) for n in range(100)]), PATH, path)
    finally:
        spark.conf.unset(setting)
    start = 0
    for row in token_files.read_tokens(spark, path).orderBy("doc_id").collect():
        assert row.start == start
        start += row.n_tokens


def test_a_part_is_looked_up_once_a_batch():
    class Counting(dict):
        lookups = 0

        def __getitem__(self, key):
            Counting.lookups += 1
            return super().__getitem__(key)

    library, machine = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    machine.known = Counting()
    texts = [f"some words, {n % 7} times\nsome words " * 30 for n in range(200)]
    found = machine.encode(texts)
    assert Counting.lookups < 100
    assert [np.frombuffer(x, "<i4").tolist() for x in found] == [library.encode(text, add_special_tokens=False).ids for text in texts]


def test_lists_of_a_slice():
    library, machine = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    texts = [text for _, text in ODD] + [None, "\n", " ", "a\n\nb  a", "A. a, İ, 日本. <s>, ß.", "x" * 70_000 + " 日" * 40_000]
    for begin, size in ((0, len(texts)), (2, 9), (1, 1), (5, 0), (len(texts) - 6, 6)):
        lists = machine.lists(pa.array(texts, pa.string()).slice(begin, size), [1])
        assert lists.to_pylist() == [library.encode(text or "", add_special_tokens=False).ids + [1] for text in texts[begin : begin + size]]
    assert machine.lists(pa.array([None, None], pa.string()), [1]).to_pylist() == [[1], [1]]


def test_batches_are_grouped_up_to_a_size():
    batches = [pa.RecordBatch.from_arrays([pa.array(["x" * size] * n, pa.string())], ["text"]) for size, n in ((10, 5), (10, 5), (5000, 2), (10, 1), (10, 0), (10, 3))]
    found = [*token_files.grouped(iter(batches), 1000)]
    assert [batch.num_rows for batch in found] == [10, 2, 4]
    assert pa.Table.from_batches(found) == pa.Table.from_batches(batches)
    assert [*token_files.grouped(iter([]))] == []


def test_a_word_is_one_part_with_all_its_capitals_and_marks(monkeypatch):
    library, machine = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    marks = ["", *string.punctuation, "!!", "###", "...", ",.", "'.", "'s", "'", "s'", "|>", "<", "<|", "≯", "́", "́.", "1!", "!a", "$ß!"]
    words = ["word", "Word", "Été", "été", "don", "I", "x×", "İ", "<|endoftext|", "<|ENDOFTEXT|", "'s", "!!"]
    texts = [" ".join(word + mark for mark in marks) for word in words] + [mark + word for word in words for mark in marks]
    for found, text in zip(machine.lists(pa.array(texts, pa.string()), [1]).to_pylist(), texts, strict=True):
        assert found == library.encode(text, add_special_tokens=False).ids + [1], text

    seen = []
    original = token_files.Pieces.ids_of
    monkeypatch.setattr(token_files.Pieces, "ids_of", lambda self, bases, is_word: seen.extend(bases) or original(self, bases, is_word))
    machine.lists(pa.array(["Word, WORD word!! word?! wOrd'", "word: Été$$ été."], pa.string()), [1])
    assert len([x for x in seen if x.lower().startswith(("word", "été"))]) == 2


def test_what_is_kept_is_bounded(monkeypatch):
    monkeypatch.setattr(token_files, "KNOWN_ENTRIES", 50)
    library, machine = Tokenizer.from_file(PATH), token_files.Pieces(PATH)
    for n in range(20):
        texts = [f"w{chr(97 + n)}{chr(97 + k)} {n}-{k}! common, 日{k}" for k in range(26)]
        assert machine.lists(pa.array(texts, pa.string()), [1]).to_pylist() == [library.encode(text, add_special_tokens=False).ids + [1] for text in texts]
    assert max(len(machine.known), len(machine.older)) < 200
