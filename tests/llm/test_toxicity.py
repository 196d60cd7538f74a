import random

import numpy as np
import pytest
from llm.docs_of import ODD, clashing, docs_of
from pyspark.sql import functions as F

from keyflow.llm import queries, toxicity
from keyflow.llm.common import table
from keyflow.llm.toxicity import Model, decay, fit, logistic, maximal_segments, predict

FILLER = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(900)]
BAD = ["grubble", "snorkwit", "blathead", "drivelbag"]
LABELS = "doc_id long, toxic int"


def by_definition(values):
    """The best stretch, then the same to its left and to its right."""
    if not values:
        return []
    sums = np.concatenate([[0.0], np.cumsum(values)])
    best = max(((sums[b] - sums[a], -b, a) for a in range(len(values)) for b in range(a + 1, len(values) + 1)), default=(0,))
    if best[0] <= 1e-9:
        return []
    score, end, first = best[0], -best[1], best[2]
    left, right = by_definition(values[:first]), by_definition(values[end:])
    return left + [(first, end, score)] + [(a + end, b + end, s) for a, b, s in right]


@pytest.mark.parametrize("seed", range(40))
def test_segments_are_those_of_the_definition(seed):
    rng = random.Random(seed)
    n = rng.randint(0, 60)
    hits = [(at, rng.uniform(-2, 4)) for at in range(n) if rng.random() < 0.5]
    values = [-0.5] * n
    for at, score in hits:
        values[at] += score
    found = maximal_segments(hits, 0.5)
    want = by_definition(values)
    assert [x[:2] for x in found] == [x[:2] for x in want]
    assert np.allclose([x[2] for x in found], [x[2] for x in want])


def test_decay_is_the_root():
    scores, shares = np.array([2.0, 1.0, -1.0]), np.array([0.05, 0.1, 0.2])
    rate = decay(scores, shares, 0.5)
    assert abs((shares * np.exp(rate * (scores - 0.5))).sum() + 0.65 * np.exp(-0.5 * rate) - 1) < 1e-9 and rate > 0
    assert decay(np.empty(0), np.empty(0), 0.5) == toxicity.MOST_RATE


def test_curve_is_most_likely_and_never_falls():
    x = np.repeat([0.0, 1.0], 100)
    y = np.array([1.0] * 10 + [0.0] * 90 + [1.0] * 80 + [0.0] * 20)
    offset, slope = logistic(x, y)
    assert 1 / (1 + np.exp(-offset)) == pytest.approx(0.1, abs=0.01) and 1 / (1 + np.exp(-offset - slope)) == pytest.approx(0.8, abs=0.01)
    assert logistic(x, 1 - y)[1] == 0
    assert all(np.isfinite(logistic(np.array([0.0, 1.0]), np.array([0.0, 1.0]))))


def corpus(n=600, seed=5):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        words, toxic = [rng.choice(FILLER) for _ in range(rng.randint(20, 120))], i % 5 == 0
        if toxic:
            at = rng.randrange(len(words))
            words[at:at] = [rng.choice(BAD).capitalize() + "," for _ in range(3)]
        texts.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return texts, labels


def test_toxic_passages_are_found_and_clean_texts_are_not(spark):
    texts, labels = corpus()
    docs = docs_of(spark, texts)
    model = fit(docs, spark.createDataFrame(labels, LABELS), F.col("doc_id") % 4 != 0)
    rows = {r.doc_id: r for r in predict(docs, model).collect()}
    for i, text in texts:
        assert rows[i].predicted == int(i % 5 == 0) and 0 <= rows[i].score <= 1
        assert bool(rows[i].passages) == (i % 5 == 0)
        for p in rows[i].passages:
            assert 0 < p.score and p.chance < toxicity.SIGNIFICANT
            assert sum(word in text[p.start : p.end].lower() for word in BAD) >= 1
    long_text = "waa wba wca. " * 300_000
    far = predict(docs_of(spark, [(1, long_text + " grubble snorkwit blathead drivelbag grubble " + long_text), (2, long_text), (3, "grubble" * 400_000)]), model)
    assert [(r.doc_id, r.predicted, len(r.passages)) for r in far.orderBy("doc_id").collect()] == [(1, 1, 1), (2, 0, 0), (3, 0, 0)]


def test_copies_count_once_and_take_the_label_of_most(spark):
    labels = [(i, int(i < 3)) for i in range(10)] + [(20, 1), (21, 0), (None, 1), (22, None), (21, 1)]
    docs = docs_of(spark, [(i, "same text") for i in range(10)] + [(20, "one"), (21, "two"), (22, "three"), (None, "four"), (20, None), (20, "five")])
    sample = toxicity.sampled(docs, spark.createDataFrame(labels, LABELS), F.lit(True), 100)
    assert {(r.text, r.toxic) for r in sample.collect()} == {("same text", False), ("one", True), ("five", True), ("two", True)}
    assert toxicity.sampled(docs, spark.createDataFrame(labels, LABELS), F.lit(True), 2).count() <= 2


def test_odd_documents_labels_and_columns(spark):
    docs = docs_of(spark, ODD)
    empty = spark.createDataFrame([], LABELS)
    nothing = fit(docs, empty, F.lit(True))
    assert {(r.score, r.predicted) for r in predict(docs, nothing).collect()} == {(0.0, 0)}
    for toxic in (0, 1, None):
        model = fit(docs, spark.createDataFrame([(r[0], toxic) for r in ODD], LABELS), F.lit(True))
        assert all(0 <= r.score <= 1 for r in predict(docs, model).collect())
    model = Model({"cat": 5.0, "mat": 4.0, "café": 9.0}, offset=-2.0, slope=3.0)
    found = predict(clashing(docs).withColumn("passages", F.lit(1)), model)
    rows = found.select("doc_id", "text", "key", "kept", "score", "predicted", "passages").collect()
    assert len(rows) == len(ODD) and {r.key for r in rows} == {"x"}
    by_text = {r.text: r for r in rows}
    first = by_text[ODD[0][1]]
    assert first.predicted == 1 and ODD[0][1][first.passages[0].start : first.passages[0].end] == "cat sat on the mat"
    base = 1 / (1 + np.exp(2.0))
    for text in (None, "", " \n\t ", "x" * 5000):
        assert by_text[text].score == pytest.approx(base) and not by_text[text].passages
    assert predict(docs.limit(0), model).count() == 0


def test_labels_lang_source_and_id_are_not_read_when_scoring(spark):
    docs = docs_of(spark, ODD)
    model = Model({"cat": 5.0}, offset=-2.0, slope=3.0)
    bare = predict(docs.select("text"), model)
    assert bare.columns == ["text", "score", "predicted", "passages"] and bare.count() == len(ODD)


def test_held_out_rows_of_the_tables(spark):
    folder = "/root/testdata/sf0.1"
    found = queries.op11_toxicity(spark, folder).join(table(spark, folder, "labels"), "doc_id").join(table(spark, folder, "documents").select("doc_id", "text"), "doc_id")
    rows = found.where("held_out").collect()
    planted = {"pathetic", "moron", "disgusting", "worthless", "scum", "idiot", "clown", "loser", "trash", "stupid"}
    toxic = [r for r in rows if r.toxic == 1 and planted & set(toxicity.words_of(r.text or ""))]
    clean = [r for r in rows if r.toxic == 0]
    print(len(toxic), len(clean))
    assert sum(r.predicted for r in toxic) >= 0.9 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
