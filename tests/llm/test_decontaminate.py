import itertools
import random

import numpy as np
import pyarrow as pa
from llm.arrow_functions import recorded
from llm.docs_of import ODD, clashing, docs_of

from keyflow.llm import decontaminate as dc


def words(rng, n):
    return ["".join(rng.choices("abcdefgh", k=6)) for _ in range(n)]


def planted(spark):
    rng = random.Random(5)
    items = {n: words(rng, 20 + n) for n in range(8)} | {8: words(rng, 6)}
    bench = spark.createDataFrame([(n, " ".join(x).upper() + ".") for n, x in items.items()] + [(None, " ".join(items[0])), (9, None), (10, "")], "item_id long, text string")
    rows, want = [*ODD], set()
    for n in range(60):
        body, item = words(rng, 200), [*items[n % 8]]
        kind = n % 4
        if kind == 1:  # one word in eight is another
            for at in range(3, len(item), 8):
                item[at] = "other"
        elif kind == 2:  # half of it
            item = item[: max(15, len(item) // 2)]
        elif kind == 3:  # every third word is another
            item = [x if at % 3 else "other" for at, x in enumerate(item)]
        at = rng.randint(0, 200)
        rows.append((1000 + n, ", ".join(body[:at] + item + body[at:])))
        if kind != 3:
            want.add((1000 + n, n % 8))
    return docs_of(spark, rows), bench, want


def test_planted_passages_are_found(spark):
    docs, bench, want = planted(spark)
    found = dc.find(clashing(docs), bench).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.n_words >= 13 and r.n_matched >= 0.8 * 13 for r in found)
    clean = dc.clean(docs, bench)
    assert clean.columns == docs.columns
    assert clean.count() == docs.count() - len({doc for doc, _ in want})


def test_a_full_map_loses_nothing(spark, monkeypatch):
    docs, bench, want = planted(spark)
    monkeypatch.setattr(dc, "bit_map", lambda hashes: b"\xff" * (1 << 20))
    assert {(r.doc_id, r.item_id) for r in dc.find(docs, bench).collect()} == want


def test_empty_tables(spark):
    docs, bench, _ = planted(spark)
    assert dc.find(docs.limit(0), bench).count() == 0
    assert dc.find(docs, bench.limit(0)).count() == 0


def test_overlap():
    doc, item = "x a b c d e y".split(), "a b c d e".split()
    assert dc.overlap(doc, item, 1, 13, 0.8) == (1, 5, 5)
    assert dc.overlap(doc, item, 2, 13, 0.8) is None
    assert dc.overlap(doc, item, 5, 13, 0.8) is None


def test_masks_leave_a_seed_whatever_is_substituted():
    for length in range(1, 14):
        wrong = max(n for n in range(length + 1) if length - n >= dc.OVERLAP_SHARE * length)
        for places in itertools.combinations(range(length), wrong):
            runs = ((mask, at) for mask in dc.MASKS[length] for at in range(length - len(mask) + 1))
            assert any(all(mask[x - at] == "0" for x in places if 0 <= x - at < len(mask)) for mask, at in runs), (length, places)


def test_short_items_are_found(spark):
    rng = random.Random(6)
    items = {n: words(rng, n) for n in range(1, 13)} | {13: words(rng, 30)}
    chinese = "我们在这里写下一个很长的句子没有空格"
    bench = spark.createDataFrame([*((n, " ".join(x)) for n, x in items.items()), (99, chinese)], "item_id long, text string")
    rows, want = [], set()
    for n, item in items.items():
        wrong = {13: 2}.get(n, n - next(k for k in range(n + 1) if k >= 0.8 * n))
        item = item[:13]
        for places in [(), *itertools.combinations(range(len(item)), wrong)]:
            text = ["other" if at in places else x for at, x in enumerate(item)]
            want.add((len(rows), n))
            rows.append((len(rows), " ".join([*words(rng, 20), *text, *words(rng, 20)])))
    want.add((len(rows), 99))
    rows.append((len(rows), f"前面{chinese[:6]}他{chinese[7:]}后面"))
    assert {(r.doc_id, r.item_id) for r in dc.find(docs_of(spark, rows), bench).collect()} == want


def test_texts_are_seeded_together(spark, monkeypatch):
    rng = random.Random(7)
    texts = [" ".join(words(rng, n % 40)) for n in range(300)] + [None, "", "one"]
    docs = docs_of(spark, [(n if n % 11 else None, text) for n, text in enumerate(texts)])
    functions = recorded(spark, monkeypatch)
    dc.seed_table(docs, "doc_id", dc.MASKS)
    alone, calls = dc.seeds, []
    monkeypatch.setattr(dc, "seeds", lambda *of: calls.append(of) or alone(*of))
    batch = pa.RecordBatch.from_pydict({"key": [n if n % 11 else None for n in range(len(texts))], "text": texts})
    found = [row for out in functions[0](iter([batch])) for row in zip(*(out[x].to_pylist() for x in ("seed", "key", "at", "mask")), strict=True)]
    numbers = {mask: number for number, mask in enumerate(sorted({mask for some in dc.MASKS.values() for mask in some}))}
    assert len(calls) <= len(numbers)
    want = []
    for n, text in enumerate(texts):
        if n % 11 and (hashed := dc.hashes_of(dc.tokens(text))).size:
            for mask in dc.MASKS[min(len(hashed), 13)]:
                want += [(seed, n, at, numbers[mask]) for at, seed in enumerate(alone(hashed, mask, numbers[mask]).view(np.int64).tolist())]
    assert sorted(found) == sorted(want) and len({(seed, mask) for seed, _, _, mask in want}) > 1000
