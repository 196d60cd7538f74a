import itertools

import numpy as np
import pytest
from llm.docs_of import ODD, clashing, docs_of
from pyspark.sql import functions as F

from keyflow.llm import language
from keyflow.llm.common import fold_of, table

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, SF_DIR, "documents")
    return language.fit(docs, fold_of(F.col("doc_id"), 5) != 0)


def test_held_out_accuracy(spark, model):
    held = table(spark, SF_DIR, "documents").where(fold_of(F.col("doc_id"), 5) == 0)
    right = language.predict(held, model).select(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0]
    assert right > 0.98


def test_path_is_the_best_of_all():
    rng = np.random.default_rng(3)
    for _ in range(60):
        scores = np.round(-rng.random((6, 3)) * 4, 2).astype(np.float32)
        penalty = float(rng.choice([0.5, 1, 3, 20]))

        def value(path):
            switches = sum(a != b for a, b in itertools.pairwise(path))
            return float(sum(scores[i, k] for i, k in enumerate(path)) - penalty * switches)

        best = max(map(value, itertools.product(range(3), repeat=6)))
        assert value(language.best_path(scores, penalty).tolist()) == pytest.approx(best, abs=1e-4)


def test_two_languages_beside_the_main_one():
    first, then = [[-1.2, 0.0, -3.0]] * 10, [[-1.2, -3.0, 0.0]] * 10
    labels = language.best_path(np.array(first + then, np.float32), 15.0)
    assert labels.tolist() == [1] * 10 + [2] * 10
    assert language.best_path(np.array(first, np.float32), 15.0).tolist() == [1] * 10


def test_mixed_text_has_spans(spark, model):
    docs = {row.lang: row.text for row in table(spark, SF_DIR, "documents").where("n_chars > 1500").select("lang", "text").collect()}
    text = docs["en"][:900] + "\n" + docs["de"][:900]
    row = language.predict(docs_of(spark, [(1, text)]), model).first()
    assert [span.lang for span in row.spans] == ["en", "de"]
    assert abs(row.spans[1].start - 901) < 40 and 0.3 < row.score < 0.7


def test_rows(spark, model):
    docs = clashing(docs_of(spark, ODD)).withColumn("lang_pred", F.lit("old"))
    found = language.predict(docs, model).collect()
    assert len(found) == len(ODD)
    for row, (doc_id, text) in zip(found, ODD, strict=True):
        assert row.doc_id == doc_id and row.text == text and row.key == "x"
        assert 0 <= row.score <= 1
        assert (row.lang_pred == "und") == (not any(c.isalpha() for c in text or ""))
    assert language.predict(docs.limit(0), model).count() == 0


def test_nothing_to_learn(spark):
    model = language.fit(docs_of(spark, ODD).limit(0), F.lit(True))
    assert {r.lang_pred for r in language.predict(docs_of(spark, ODD), model).collect()} == {"und"}


def test_scripts():
    assert language.script_of_word("hello") == "Latin"
    assert language.script_of_word("привет") == "Cyrillic"
    assert language.script_of_word("日本") == "Han"
    assert language.script_of_word("aбв") == "Cyrillic"
