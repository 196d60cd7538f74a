import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from llm.docs_of import ODD, clashing, docs_of
from pyspark.sql import functions as F

from keyflow.llm import brown
from keyflow.llm.common import fold_of, table

LOWER = {i: i + 32 for i in range(65, 91)}


def held_out():
    return fold_of(F.col("doc_id"), 10) == 0


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 == 0


def check_base(rows, found):
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    ends = sum(not held(i) for i, _ in rows)
    total, distinct = sum(counts.values()) + ends, len(counts) + (ends > 0)

    def p(n):
        return math.log10((n + 0.1) / (total + 0.1 * (distinct + 1)))

    want = sorted((str(i), held(i), len(words(t)) + 1, sum(counts[w] > 0 for w in words(t)) + (ends > 0), round(sum(p(counts[w]) for w in words(t)) + p(ends), 6)) for i, t in rows)
    assert sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, round(r.base_score, 6)) for r in found) == want
    assert {r.train_tokens for r in found} == {total}


def test_base_scores_and_the_gain_of_the_model(spark):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    found = brown.score(docs, held_out()).collect()
    check_base(rows, found)
    out = [r for r in found if r.held_out]
    assert sum(r.score for r in out) > sum(r.base_score for r in out)
    assert all(r.score < 0 and r.perplexity > 1 for r in found)


def test_odd_rows(spark):
    docs = clashing(docs_of(spark, ODD))
    found = brown.score(docs, held_out()).collect()
    check_base(ODD, found)
    assert all(math.isfinite(r.score) for r in found)
    assert brown.score(docs.limit(0), held_out()).count() == 0
    assert all(math.isfinite(r.score) and r.train_tokens == 0 for r in brown.score(docs, F.lit(True)).collect())


def test_frequent_words_are_those_of_all_training_texts(spark, monkeypatch):
    """Whatever part of the texts they are in; equal counts in order of the words. Held-out texts count for nothing."""
    rows = [(i, f"{'Late ' * 9 if i > 5500 else 'early'} w{i % 40:02d} {'held' if held(i) else ''}") for i in range(6000)]
    counts = Counter(w for i, t in rows if not held(i) for w in words(t))
    given, frequent_words = [], brown.frequent_words
    monkeypatch.setattr(brown, "frequent_words", lambda *args: given.append(frequent_words(*args)) or given[-1])
    check_base(rows, brown.score(docs_of(spark, rows), held_out(), frequent=20).collect())
    assert [r.chosen.split(" ") for r in given[0].collect()] == [sorted(counts, key=lambda w: (-counts[w], w))[:20]]


def test_classes_follow_a_pattern():
    """Words of two kinds in turn: exchange finds the kinds."""
    rng = np.random.default_rng(4)
    line = [int(rng.integers(0, 6)) + 6 * (n % 2) for n in range(4000)]
    matrix = np.zeros((14, 14))
    np.add.at(matrix, (line[:-1], line[1:]), 1)
    of = brown.exchange(matrix, 12, classes=2)
    assert len({*of[:6].tolist()}) == 1 and len({*of[6:12].tolist()}) == 1 and of[0] != of[6]


def test_no_single_move_raises_the_likelihood():
    rng = np.random.default_rng(6)
    matrix = rng.integers(0, 40, (11, 11)).astype(float)

    def likelihood(of):
        table = np.zeros((5, 5))
        np.add.at(table, (of[:, None], of[None, :]), matrix)
        f = brown.entropy
        return f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum()

    of = brown.exchange(matrix, 9, classes=3, sweeps=50)
    assert of[9:].tolist() == [3, 4]
    best = likelihood(of)
    for word in range(9):
        for k in range(3):
            other = of.copy()
            other[word] = k
            assert likelihood(other) <= best + 1e-6


def test_the_model_is_a_distribution():
    rng = np.random.default_rng(5)
    frequent, symbols = 5, 5 + brown.BANDS + 1
    line = rng.choice([0, 1, 2, 3, 4, 6, 7, 8, symbols - 1], 3000)
    matrix = np.zeros((symbols, symbols))
    np.add.at(matrix, (line[:-1], line[1:]), 1)
    model = brown.Model.of(matrix, frequent)
    assert np.allclose((10**model.transitions).sum(axis=1), 1)
    single = 10 ** model.emissions[:frequent]
    assert np.allclose(np.bincount(model.classes[:frequent], single)[np.unique(model.classes[:frequent])], 1)
    assert model.emissions[frequent + 1] == pytest.approx(-np.log10(matrix[:, frequent + 1].sum()))


def likely(table):
    f = brown.entropy
    return f(table).sum() - f(table.sum(axis=0)).sum() - f(table.sum(axis=1)).sum()


def test_gains_are_those_of_the_likelihood():
    """Each word, out of any class or band, into any class: against the likelihood of the whole table."""
    rng = np.random.default_rng(8)
    words, size, classes = 12, 6, 3
    matrix = rng.poisson(rng.choice([0.2, 3, 40], (words + 1, words + 1))).astype(float)
    matrix[-1, -1] = 0
    of = np.r_[rng.integers(0, size - 1, words), size - 1]

    def table_of(of):
        table = np.zeros((size, size))
        np.add.at(table, (of[:, None], of[None, :]), matrix)
        return table

    own, line = np.diag(matrix)[:words].copy(), np.arange(words)
    after = np.array([np.bincount(of, row, size) for row in matrix[:words]])
    before = np.array([np.bincount(of, row, size) for row in matrix.T[:words]])
    for side in (after, before):
        side[line, of[:words]] -= own
    found = brown.gains(after, before, own, of[:words], table_of(of), classes)
    for word in range(words):
        want = [likely(table_of(np.where(np.arange(words + 1) == word, k, of))) for k in range(classes)]
        assert np.allclose(found[word] - found[word, 0], np.array(want) - want[0])


def test_packed_numbers_come_back():
    for heads, others in ((0, 0), (0, 3), (4, 1), (5, 2000)):
        rng = np.random.default_rng(others)
        given = rng.integers(0, 2**32, heads), rng.integers(0, 2**32, others), rng.integers(0, 2**60, others)
        assert all(np.array_equal(a, b) for a, b in zip(given, brown.loosened(brown.squeezed(*given)), strict=True))


def kinds(n, seed, turn=True):
    """Words of two kinds in turn, or at random; far more than are clustered first, and each about as frequent."""
    rng = np.random.default_rng(seed)
    return " ".join(f"{'ab'[k % 2 if turn else int(rng.integers(0, 2))]}{int(rng.integers(0, 30)):02d}" for k in range(n))


def test_words_beyond_the_frequent_ones_have_classes(spark):
    rows = [(i, kinds(40, i)) for i in range(200)]
    rows += [(1000 + i, kinds(40, i, turn=False)) for i in range(30)]
    found = brown.score(docs_of(spark, rows), F.col("doc_id") % 5 == 0, frequent=4, classes=2)
    scores = {r.doc_id: r.score for r in found.where("held_out").collect()}
    in_turn = [s for i, s in scores.items() if i < 1000]
    mixed = [s for i, s in scores.items() if i >= 1000]
    assert len(in_turn) == 40 and len(mixed) == 6
    assert min(in_turn) > max(mixed) + 2


def numbers_of(count, frequent, buckets):
    order = sorted(count, key=lambda w: (-count[w], w.encode()))
    numbers = {w: at for at, w in enumerate(order[:frequent])}
    for bucket in range(buckets):
        for at, w in enumerate(w for w in order if zlib.crc32(w.encode()) % buckets == bucket):
            numbers.setdefault(w, frequent + at * buckets + bucket)
    return numbers


def test_score_is_that_of_the_classes_and_no_sweep_loses(spark, monkeypatch):
    """The model of the classes again from its definition, every word of the training texts in a class; held-out words unseen."""
    rng = np.random.default_rng(3)
    rows = [(i, " ".join(f"w{int(x)}" for x in rng.zipf(1.4, 30) % 90) + f" only{i}" if i % 11 else "") for i in range(150)]
    tables, classes, likelihood, exchanged = [], [], brown.likelihood, brown.exchanged
    monkeypatch.setattr(brown, "likelihood", lambda table: tables.append(table) or likelihood(table))
    monkeypatch.setattr(brown, "exchanged", lambda *args, **more: classes.append(exchanged(*args, **more)) or classes[-1])
    monkeypatch.setattr(brown, "ROW_PAIRS", 50)
    monkeypatch.setattr(brown, "HELD_PAIRS", 400)
    found = {r.doc_id: r for r in brown.score(docs_of(spark, rows), held_out(), frequent=10, classes=4).collect()}
    lines = {i: ["", *words(t), ""] for i, t in rows}
    count = Counter(w for i, line in lines.items() if not held(i) for w in line[1:-1])
    numbers = numbers_of(count, 10, int(spark.conf.get("spark.sql.shuffle.partitions")))
    of = {w: int(classes[0][number]) for w, number in numbers.items()}
    assert {*of.values()} == {0, 1, 2, 3}

    def shares(word):
        if not word:
            return {5: 1.0}
        return {4: 1.0} if word not in of else {of[word]: 0.5, 4: 0.5} if count[word] == 1 else {of[word]: 1.0}

    table, plain = np.zeros((6, 6)), np.zeros((5, 5))
    for line in (line for i, line in lines.items() if not held(i)):
        for u, v in zip(line[:-1], line[1:], strict=True):
            plain[of.get(u, 4), of.get(v, 4)] += 1
            for c, x in shares(u).items():
                for d, y in shares(v).items():
                    table[c, d] += x * y
    sizes = table.sum(axis=0)
    usual = (sizes + 0.1) / (sizes.sum() + 0.6)
    after = (table + 20 * usual) / (table.sum(axis=1, keepdims=True) + 20)

    def place(word):
        return of.get(word, 4) if word else 5

    for i, line in lines.items():
        want = sum(math.log10(after[place(u), place(v)]) for u, v in zip(line[:-1], line[1:], strict=True))
        want += sum(math.log10(count[w] * (0.5 if count[w] == 1 else 1) / sizes[of[w]]) for w in line[1:-1] if w in of)
        assert found[i].score == pytest.approx(want, abs=1e-6)
    # each trial meets the best table so far, and the last of them is the result
    values, best = [likelihood(table) for table in tables], None
    for trial, before in zip(values[::2], values[1::2], strict=True):
        assert best is None or before == best
        best = max(trial, before)
    assert len(values) > 2 and best > values[1] and best == pytest.approx(likelihood(plain))
