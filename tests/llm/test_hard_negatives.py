import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from keyflow.llm import hard_negatives, queries
from keyflow.llm.hard_negatives import mine, relabelled, scores_of

SCHEMA = "vec_id long, embedding array<float>, label int"
NAMES = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def brute(rows, every=50, positives=5, negatives=3):
    """The definition, row by row, in Python's whole numbers."""
    usable = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows if label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for at, (anchor, vector, label) in enumerate(usable):
        if anchor is None or anchor % every:
            continue
        scored = [(-sum(x * y for x, y in zip(vector, v, strict=True)), i is None, i or 0, i, lab) for k, (i, v, lab) in enumerate(usable) if k != at and len(v) == len(vector)]
        scored.sort(key=lambda s: s[:3])
        for score, _, _, positive, _ in [s for s in scored if s[4] == label][:positives]:
            score = -score
            fit = [s for s in scored if s[4] != label and 50 * score <= -100 * s[0] <= 95 * score][:negatives]
            out += [(anchor, positive, rank, s[3], score, -s[0]) for rank, s in enumerate(fit, 1)]
    return Counter(out)


def mined(spark, rows, every=50, **limits):
    frame = spark.createDataFrame(rows, SCHEMA)
    return Counter(tuple(row[n] for n in NAMES) for row in mine(frame, F.col("vec_id") % every == 0, F.col("label"), **limits).collect())


def vectors(n, dims, seed=1, scale=0.2):
    """Clustered vectors, as single floats."""
    rng = np.random.default_rng(seed)
    centres = rng.standard_normal((4, dims))
    kinds = rng.integers(0, 4, n)
    found = ((centres[kinds] + rng.standard_normal((n, dims)) * 0.8) * scale).astype(np.float32)
    return [(i, v.tolist(), int(k + rng.integers(0, 2))) for i, (v, k) in enumerate(zip(found, kinds, strict=True))]


@pytest.mark.parametrize("low, high", [(0, 1), (-3, 4), (-300, 300), (-(2**20), 2**20), (-(2**26), 2**26), (5, 6)])
@pytest.mark.parametrize("shape", [(1, 1, 1), (3, 7, 5), (4, 64, 33)])
def test_products_are_exact(low, high, shape):
    rng = np.random.default_rng(3)
    a, c = rng.integers(low, high, (shape[0], shape[1])), rng.integers(low, high, (shape[2], shape[1]))
    want = [[sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for q in c] for p in a]
    assert scores_of(a.astype(float), c.astype(float)).tolist() == want


def test_products_with_extreme_fields_do_not_run_into_each_other():
    a, c = np.full((2, 64), -256.0), np.full((9, 64), 256.0)
    a[1], c[::2] = 256.0, -256.0
    assert scores_of(a, c).tolist() == [[64 * 65536 * (1 if at % 2 == 0 else -1) * sign for at in range(9)] for sign in (1, -1)]


def test_products_beyond_a_long_become_its_end():
    a = np.array([[2.0**40, 1.0], [-(2.0**40), 0.0]])
    assert scores_of(a, np.array([[2.0**40, 3.0], [1.0, 2.0**30]])).tolist() == [[2**63 - 1, 2**40 + 2**30], [-(2**63 - 1), -(2**40)]]


@pytest.mark.parametrize("limits", [{}, {"block_anchors": 3}, {"block_components": 40}])
def test_equals_the_definition(spark, limits):
    rows = vectors(300, 6)
    want = brute(rows, 10)
    assert want and mined(spark, rows, 10, **limits) == want


@pytest.mark.parametrize("batch, cells", [(1, 1), (16, 50), (10_000, 1 << 21)])
def test_small_batches_and_stretches_find_the_same(monkeypatch, batch, cells):
    monkeypatch.setattr(hard_negatives, "BATCH_ROWS", batch)
    monkeypatch.setattr(hard_negatives, "CELLS", cells)
    ids, parts, labels = zip(*vectors(200, 5), strict=True)
    rows = pa.table({"_n": pa.array(ids), "_id": pa.array(ids), "_label": pa.array(labels, pa.int64()), "_vector": pa.array(parts, pa.list_(pa.float32()))})
    anchors = hard_negatives.Anchors(rows.slice(0, 20))
    best = hard_negatives.best_positives(iter(rows.to_batches(max_chunksize=7)), anchors, 6)
    found = pa.Table.from_batches([hard_negatives.best_rows(best, ["slot", "score", "id"])[1]])
    scores, positive, n = hard_negatives.own_removed(anchors, found, 5)
    worst = hard_negatives.best_negatives(iter(rows.to_batches(max_chunksize=7)), anchors, scores, n, 3)
    got = Counter()
    for slot in range(len(worst.found)):
        for place in range(worst.found[slot]):
            at, of = divmod(slot, 5)
            got[at, int(positive[at, of]), place + 1, int(worst.ids[slot, place]), int(scores[at, of]), int(worst.scores[slot, place])] += 1
    assert got == Counter({row: n for row, n in brute(list(zip(ids, parts, labels, strict=True)), 1).items() if row[0] < 20})


def test_large_components_take_long_integers(spark):
    rows = [(i, v, label) for i, v, label in vectors(60, 3, scale=30000.0)]
    want = brute(rows, 10)
    assert want and mined(spark, rows, 10) == want


def test_one_vector_and_one_label_hold_most_rows(spark):
    rows = vectors(150, 4)
    rows += [(1000 + i, [0.5, 0.25, -0.5, 0.125], 1 + (i % 2)) for i in range(300)]
    want = brute(rows, 50)
    assert want and mined(spark, rows) == want


def test_ties_repeated_rows_and_odd_vectors(spark):
    rows = [(0, [1.0, 0.0], 1), (0, [1.0, 0.0], 1), (3, [1.0, 0.0], 1), (2, [1.0, 0.0], 1), (1, [0.75, 0.0], 2), (4, [0.75, 9.0], 2), (5, [0.5, 1.0], 3)]
    rows += [(6, [0.49, 0.0], 3), (None, [0.75, 0.5], 2), (None, [1.0, 0.0], 1), (50, [], 1), (51, [], 2), (52, [], 1), (100, [0.0, 0.0], 1)]
    rows += [(7, None, 1), (8, [1.0, None], 2), (9, [math.nan, 1.0], 2), (10, [math.inf, 1.0], 2), (11, [0.8, 0.0], None), (12, [1.0], 2), (150, [1.0], None)]
    want = brute(rows)
    assert want and mined(spark, rows) == want
    assert not mined(spark, [(0, [1.0], 1)]) and not mined(spark, []) and not mined(spark, [(1, [1.0], 1), (2, [1.0], 2)])


def test_other_columns_are_not_read(spark):
    rows = vectors(120, 3)
    names = {n: F.lit("x") for n in ("_id", "_n", "_label", "slot", "rank", "score", "anchor_id", "_vector")}
    frame = spark.createDataFrame(rows, SCHEMA).withColumns(names)
    found = Counter(tuple(row[n] for n in NAMES) for row in mine(frame, F.col("vec_id") % 50 == 0, F.col("label")).collect())
    assert found == brute(rows)


def test_query_equals_its_sql(spark):
    from tools.check_oracles import compare, duck

    folder = "/root/testdata/sf0.01"
    assert compare(spark, duck(folder), folder, "op13", queries.op13_hard_negatives, queries.ORACLES["op13_hard_negatives"]).startswith("ok")


def test_every_seventh_label_moves_on(spark):
    frame = spark.createDataFrame([(7, 9), (8, 9), (14, 3), (None, 4), (21, None)], "vec_id long, label int")
    assert [row[0] for row in frame.select(relabelled()).collect()] == [0, 9, 4, 4, None]
