import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyflow.llm import nearest
from keyflow.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def brute(ids, vectors, query, k):
    scores = (vectors * vectors[list(ids).index(query)]).sum(axis=1)
    order = [at for at in np.lexsort((ids, -scores)) if ids[at] != query]
    return [(ids[at], scores[at]) for at in order[:k]]


def results(found):
    out = {}
    for row in sorted(found.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(row.query_id, []).append((row.vec_id, row.score))
    return out


def test_recall_on_the_table(spark):
    frame = table(spark, "/root/testdata/sf0.1", "embeddings")
    rows = frame.select("vec_id", "embedding").collect()
    ids, vectors = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    found = results(nearest.search(frame, F.col("vec_id") % 20 == 0))
    hits = [len({x for x, _ in found[q]} & {x for x, _ in brute(ids, vectors, q, 20)}) for q in found]
    assert len(found) == sum(ids % 20 == 0) and sum(hits) / (20 * len(hits)) >= 0.9
    query = next(iter(found))
    assert [score for _, score in found[query]] == sorted((score for _, score in found[query]), reverse=True)


@pytest.mark.parametrize("block", [7, 20_000])
def test_all_lists_give_the_exact_answer(spark, monkeypatch, block):
    monkeypatch.setattr(nearest, "BLOCK_ROWS", block)
    rng = np.random.default_rng(2)
    vectors = np.concatenate([rng.standard_normal((80, 18)) * rng.random((80, 1)) * 5, np.repeat(rng.standard_normal((1, 18)), 30, axis=0)]).astype(np.float32).astype(float)
    ids = np.arange(len(vectors))
    frame = spark.createDataFrame([(int(i), v.tolist()) for i, v in zip(ids, vectors, strict=True)], SCHEMA)
    found = results(nearest.search(frame, F.col("vec_id") % 20 == 0, k=9, probe_share=1.0))
    for query in range(0, len(ids), 20):
        want = brute(ids, vectors, query, 9)
        assert [x for x, _ in found[query]] == [x for x, _ in want]
        assert np.allclose([s for _, s in found[query]], [s for _, s in want], rtol=1e-12)


def test_odd_vectors(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.5, 0.5]), (2, [0.0, 0.0]), (3, None), (4, [math.nan, 1.0]), (5, [math.inf, 1.0]), (6, [1.0, None])]
    rows += [(None, [1.0, 1.0]), (7, [1.0]), (8, []), (20, [0.0, 2.0]), (40, None), (1, [0.5, 0.5])]
    frame = spark.createDataFrame(rows, SCHEMA).withColumns({"list": F.lit(1), "score": F.lit("x"), "rank": F.lit(3)})
    found = results(nearest.search(frame, F.col("vec_id") % 20 == 0))
    assert found == {0: [(1, 0.5), (1, 0.5), (20, 0.0)], 20: [(1, 1.0), (1, 1.0), (0, 0.0)]}
    assert nearest.search(frame.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest.search(frame.where("vec_id = 0"), F.col("vec_id") % 20 == 0).count() == 0
