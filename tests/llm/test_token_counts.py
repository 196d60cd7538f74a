import math

import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.docs_of import ODD, clashing, docs_of

from keyflow.llm import token_counts as tc

PIECES = {"a": -1.0, "b": -1.5, "ab": -2.0, "abc": -2.25, "ba": -3.0, "aa": -1.75, "▁": -0.5, "▁a": -1.0}
PATH = public_tokenizers.path("piece_bpe_32k.model")


def best_of_all(word, unknown):
    """The best (score, minus tokens) over all splits, left to right."""
    best = None

    def go(at, score, tokens):
        nonlocal best
        if at == len(word):
            best = max(best, (score, -tokens)) if best else (score, -tokens)
            return
        for end in range(at + 1, len(word) + 1):
            if word[at:end] in PIECES:
                go(end, score + PIECES[word[at:end]], tokens + 1)
        if word[at] not in PIECES:
            spelled = len(word[at].encode())
            go(at + 1, score + unknown * spelled, tokens + spelled)

    go(0, 0.0, 0)
    return best


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text("abcé▁", min_size=1, max_size=9), min_size=1, max_size=20))
def test_trie_equals_all_splits(words):
    trie = tc.UnigramTrie(PIECES, -4.0)
    found = trie.terminals(list(set(words)))
    for word, (tokens, score) in found.items():
        want = best_of_all(word, -4.0)
        assert math.isclose(score, want[0]) and tokens == -want[1]
        split = trie.split(word)
        assert len(split) == tokens
        assert math.isclose(sum(PIECES.get(x, -4.0) for x in split), score)


def test_rows(spark):
    docs = clashing(docs_of(spark, ODD))
    found = tc.count_tokens(docs, PATH).collect()
    assert len(found) == len(ODD)
    trie = tc.trie_of(PATH)
    for row, (doc_id, text) in zip(found, ODD, strict=True):
        words = tc.WORD.findall(text or "")
        assert (row.doc_id, row.n_words) == (doc_id, len(words))
        assert row.n_tokens == sum(len(trie.split("▁" + word)) for word in words)
    assert tc.count_tokens(docs.limit(0), PATH).count() == 0


def test_words_of_the_corpus(spark):
    rows = [(1, "a b a"), (2, "a"), (3, None)]
    found = {r.word: r.occurrences for r in tc.word_counts(docs_of(spark, rows), PATH).collect()}
    assert found == {"a": 3, "b": 1}


def test_scores_are_a_distribution():
    assert sum(map(math.exp, tc.zipf_scores(1000))) == pytest.approx(1)
