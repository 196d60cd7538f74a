import random
import re

import numpy as np
import pytest
from llm.docs_of import ODD, clashing, docs_of

from keyflow.llm import components as cc
from keyflow.llm import near_copies as nc

LOWER = {i: i + 32 for i in range(65, 91)}


def set_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(words)} if 0 < len(words) < 5 else {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows, similarity=85):
    sets = [(i, set_of(t)) for i, t in rows]
    root = {i: i for i, _ in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for at, (i, a) in enumerate(sets):
        for j, b in sets[:at]:
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in sets}


def corpus(seed):
    rng = random.Random(seed)
    rows = []
    for group in range(12):
        base = [f"w{rng.randint(0, 400)}" for _ in range(rng.choice([3, 8, 60, 200]))]
        for _ in range(rng.choice([1, 2, 9])):
            text = [*base]
            for _ in range(rng.choice([0, 0, 1, 2])):
                text[rng.randrange(len(text))] = f"new{rng.randint(0, 99)}"
            rows.append(" ".join(text).upper() if rng.random() < 0.2 else "\n ".join(text))
    chain = [f"c{n}" for n in range(140)]
    rows += [" ".join(chain[n : n + 110]) for n in range(0, 30, 5)]  # each like the next, the ends not alike
    rng.shuffle(rows)
    return [*enumerate(rows, 100)]


@pytest.mark.parametrize("options", [{}, {"node_docs": 3, "levels": 1, "trees": 12}])
def test_equals_all_pairs(spark, options):
    rows = corpus(3) + [(n, f"{ODD[0][1]}") for n in range(900, 940)] + [(1, None), (2, ""), (3, " \n")]
    found = {r.doc_id: r for r in nc.classes(clashing(docs_of(spark, rows)), **options).collect()}
    want = brute(rows)
    assert len(found) == len(rows)
    if not options:
        assert {i: (r.n_shingles, r.component_id) for i, r in found.items()} == want
    for i, row in found.items():  # small blocks may miss a link, never make one up
        assert row.kept == (row.component_id == i) and row.n_shingles == want[i][0]
        assert want[row.component_id][1] == want[i][1]


def test_large_nodes_are_compared_whole(spark):
    rng = random.Random(4)
    base = [f"w{n}" for n in range(400)]
    family = []
    for n in range(40):  # alike by about 0.83, too little for a link
        text = [*base]
        for at in range(n % 5, 400, 55):
            text[at] = f"x{n}_{at}"
        family.append(text)
    for n in range(0, 40, 2):  # each second one has a single near copy
        text = [*family[n]]
        text[7 + n] = "other"
        family.append(text)
    rng.shuffle(family)
    rows = [*enumerate(map(" ".join, family))]
    found = nc.classes(docs_of(spark, rows), node_docs=3, levels=0, trees=3).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == brute(rows)


def test_odd_rows(spark):
    docs = clashing(docs_of(spark, ODD))
    found = nc.classes(docs).collect()
    assert len(found) == len(ODD)
    by = {}
    for row in found:
        by.setdefault(row.doc_id, []).append(row)
    assert all(r.kept and r.component_id is None for r in by[None])
    assert [r.n_shingles for x in (2, 3, 4) for r in by[x]] == [0, 0, 0]
    assert all(r.component_id == 5 for r in by[5])
    assert nc.classes(docs.limit(0)).count() == 0
    assert nc.deduplicated(docs).columns == docs.columns


def test_one_of_each_group_stays(spark):
    rows = corpus(8)
    want = brute(rows, 80)
    kept = {r.doc_id for r in nc.deduplicated(docs_of(spark, rows), 80).collect()}
    assert kept == {i for i, (_, root) in want.items() if i == root}


def test_tokens_estimate_similarity():
    rng = np.random.default_rng(1)
    whole = rng.integers(0, 1 << 63, 2000).astype(np.uint64)
    a, b = np.unique(whole[:1900]), np.unique(whole[100:])
    agree = (np.frombuffer(nc.minwise(a).tobytes(), "<u4") == np.frombuffer(nc.minwise(b).tobytes(), "<u4")).mean()
    assert abs(agree - len(np.intersect1d(a, b)) / len(np.union1d(a, b))) < 0.15


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(60)] + [(n, n + 1) for n in range(200, 240)]
    rng.shuffle(links)
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    want = {(x, find(x)) for x in list(root) if find(x) != x}
    found = cc.components(spark.createDataFrame(links, "a long, b long"))
    assert {(r.node, r.root) for r in found.collect()} == want
    assert cc.components(spark.createDataFrame([], "a long, b long")).count() == 0
