import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm.docs_of import ODD, clashing, docs_of

from keyflow.llm import repeats


def brute(rows, window=repeats.WINDOW):
    """(removed, spans, kept) by id, straight from the definition; ids distinct."""
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        mark = bytearray(len(data))
        for start in range(len(data) - window + 1):
            part = data[start : start + window]
            if part in seen:
                mark[start : start + window] = b"\1" * window
            seen.add(part)
        kept = bytes(x for x, gone in zip(data, mark, strict=True) if not gone)
        out[doc_id] = (len(data), sum(mark), len([x for x in bytes(mark).split(b"\0") if x]), kept)
    return out


def corpus(seed):
    rng = random.Random(seed)

    def prose(n):
        return "".join(rng.choices("abcdeé \n", k=n))

    passages = [prose(n) for n in (99, 100, 101, 150, 400)]
    rows = []
    for n in range(60):
        parts = [prose(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 3)):
            passage = rng.choice(passages)
            cut = rng.randint(0, 60)
            parts += [passage if rng.random() < 0.6 else passage[cut:], prose(rng.choice([0, 1, 40]))]
        rows.append((n, "".join(parts)))
    rows += [(100, rows[3][1]), (101, rows[3][1]), (102, "a" * 450), (103, "ab" * 300), (104, None), (105, "")]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group_rows", [1, 3, repeats.GROUP_ROWS])
def test_equals_the_definition(spark, group_rows):
    rows = corpus(group_rows)
    found = repeats.remove(docs_of(spark, rows), group_rows=group_rows).collect()
    assert {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in found} == brute(rows)
    assert len(found) == len(rows)


def test_rows_with_shared_or_null_ids(spark):
    text = "the same words again and again in a text of more than one hundred bytes, " * 2
    rows = ODD + [(None, text), (None, text), (-9, text), (50, text), (50, text), (50, text + "more")]
    docs = clashing(docs_of(spark, rows))
    found = repeats.remove(docs).collect()
    assert len(found) == len(rows) and all(row.key == "x" for row in found)
    whole = [r for r in found if r.text == text and r.n_removed < len(text) // 2 + 20]
    assert len(whole) == 1 and whole[0].doc_id is None
    assert repeats.remove(docs.limit(0)).count() == 0


def test_text_without_cut_characters(spark):
    passage = "".join(random.Random(3).choices("éèüñçàö", k=80))
    rows = [(1, passage), (2, "x" + passage + "y"), (3, "ö" + passage[1:] if passage[0] != "ö" else "é" + passage[1:])]
    kept = {r.doc_id: r.kept for r in repeats.remove(docs_of(spark, rows), as_text=True).collect()}
    assert kept[1] == passage and kept[2] == "xy"
    # the second byte of its first letter is that of the passage's first one, or is not: no half letter stays
    assert len(kept[3]) <= 1


runs = st.lists(st.lists(st.binary(max_size=6), max_size=12), min_size=1, max_size=9)


@settings(max_examples=200, deadline=None)
@given(runs)
def test_loser_tree_merges(lists):
    def run(items):
        before = b""
        for item in sorted(items):
            yield item, repeats.common_prefix(before, item, 0), (item,)
            before = item

    out = [*repeats.LoserTree([run(items) for items in lists])]
    assert [x for x, _, _ in out] == sorted(x for items in lists for x in items)
    for (a, _, _), (b, shared, payload) in zip(out, out[1:], strict=False):
        assert shared == repeats.common_prefix(a, b, 0) and payload == (b,)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=60), st.binary(max_size=30), *[st.integers(0, 99)] * 3), max_size=20))
def test_front_coding_round_trip(entries):
    entries.sort()
    if entries:
        assert [(s, (left, *place, 5)) for s, left, *place in entries] == [(s, p) for s, _, p in repeats.decoded(5, *repeats.coded(entries))]


@settings(max_examples=100, deadline=None)
@given(st.binary(max_size=400))
def test_every_window_has_one_anchor(data):
    at, first, last, _ = repeats.anchors(data)
    covered = [start for a, b in zip(first.tolist(), last.tolist(), strict=True) for start in range(a, b + 1)]
    assert covered == list(range(max(0, len(data) - repeats.WINDOW + 1)))
    assert all(b <= a and a + repeats.GRAM <= f + repeats.WINDOW for a, f, b in zip(at.tolist(), first.tolist(), last.tolist(), strict=True) if b <= a)


def test_pieces_of_long_texts(monkeypatch):
    data = random.Random(1).randbytes(3000)
    whole = repeats.anchors(data)
    monkeypatch.setattr(repeats, "PIECE", 500)
    cut = repeats.anchors(data)
    assert [(a, range(f, b + 1)) for a, f, b in zip(*(x.tolist() for x in whole[:3]), strict=True)][0][0] == cut[0][0]
    owner = {p: a for a, f, b in zip(*(x.tolist() for x in whole[:3]), strict=True) for p in range(f, b + 1)}
    assert owner == {p: a for a, f, b in zip(*(x.tolist() for x in cut[:3]), strict=True) for p in range(f, b + 1)}
