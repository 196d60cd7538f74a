import re
from collections import Counter, defaultdict

import pytest
from llm.docs_of import ODD, clashing, docs_of
from pyspark.sql import functions as F

from keyflow.llm import queries, source_divergence
from keyflow.llm.source_divergence import audit, kept_terms, staged_terms

NAMES = ["lang", "source", "part", "item", "value", "rank"]


def brute(rows, least=10, top=10):
    """The definition over rows of text, lang and source, in Python's whole numbers."""
    docs = [[x or "" for x in row] for row in rows]
    lower = {c: c + 32 for c in range(65, 91)}
    found = [(lang, source, Counter(re.findall(r"[a-z\x80-\U0010ffff]+", text.translate(lower)))) for text, lang, source in docs]
    having, counts = defaultdict(Counter), defaultdict(Counter)
    for lang, source, terms in found:
        having[lang].update(terms.keys())
        counts[lang, source].update(terms)
    out = Counter()
    for lang, n_docs in having.items():
        kept = sorted((t for t, n in n_docs.items() if n >= least), key=lambda t: t.encode())
        groups = {source: Counter({t: c[t] for t in kept}) for (x, source), c in counts.items() if x == lang}
        whole = sum(groups.values(), Counter())

        def shares(c, kept=kept):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept)) for t in kept}

        def far(p, q):
            return (p - q) ** 2 // (p + q)

        of_lang, of = shares(whole), {source: shares(c) for source, c in groups.items()}
        for source, p in of.items():
            pairs = [(-sum(far(p[t], q[t]) for t in kept), other.encode(), other) for other, q in of.items() if other != source]
            terms = [(-far(p[t], of_lang[t]), t.encode(), t) for t in kept if groups[source][t] and p[t] > of_lang[t]]
            for part, items, most in (("pair", pairs, None), ("term", terms, top)):
                out.update((lang, source, part, item, -value, rank) for rank, (value, _, item) in enumerate(sorted(items)[:most], 1))
    return out


def audited(spark, rows, **settings):
    frame = spark.createDataFrame(rows, "text string, lang string, source string")
    return Counter(tuple(row[n] for n in NAMES) for row in audit(frame, **settings).collect())


def texts(n=90):
    """Terms with shared prefixes of several lengths, some below the threshold only as whole terms."""
    out = []
    for i in range(n):
        words = ["Common", "übung", f"prefixwithalongtail{'abc'[i % 3]}", f"common{chr(97 + i % 26)}", "zz" * (i % 5), f"rare{'x' * i}"]
        words += ["alpha"] * (i % 4) + ["beta-gamma"] * (i % 3) + ["日本語"] * (i % 2) + (["tie", "eit"] if i % 6 == 0 else [])
        out.append((" ".join(words), ["en", "de", None][i % 3 if i % 7 else 0], f"s{i % 4}" if i % 11 else None))
    return out


@pytest.mark.parametrize("first", [1, 4, 100])
def test_equals_the_definition(spark, first):
    rows = texts() + [("", "en", "empty"), (None, "en", "null"), ("few words only", "xx", "a"), ("few", "xx", "b"), (None, None, None)]
    want = brute(rows)
    assert want and audited(spark, rows, first_bytes=first) == want


def test_small_tiles_chunks_flushes_and_salted_groups_change_nothing(spark, monkeypatch):
    rows = [(text, "en", f"s{i % 9}") for i, (text, _, _) in enumerate(texts(60))]
    want = brute(rows, 3)
    monkeypatch.setattr(source_divergence, "TILE_SOURCES", 2)
    monkeypatch.setattr(source_divergence, "TILE_ROWS", 20)
    monkeypatch.setattr(source_divergence, "CELLS", 9)
    monkeypatch.setattr(source_divergence, "ENTRIES", 5)
    monkeypatch.setattr(source_divergence, "BROADCAST_GROUPS", 0)
    assert audited(spark, rows, least_docs=3) == want


def test_a_full_map_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(source_divergence.Known, "has", lambda self, hashed: True)
    rows = texts()
    assert audited(spark, rows) == brute(rows)


def test_levels_drop_prefixes_that_too_few_documents_have(spark):
    rows = [(f"shared{chr(97 + i)} same", "en", "s") for i in range(12)] + [("same", "en", "s")]
    staged = staged_terms(spark.createDataFrame(rows, "text string, lang string, source string"))
    assert {bytes(r.prefix) for r in kept_terms(staged).collect()} == {b"same"}
    level = source_divergence.prefixes(staged, 4, 0, None).collect()
    assert {(bytes(r.prefix), r.complete, r.docs) for r in level} == {(b"shar", False, 12), (b"same", True, 13)}


def test_one_source_holds_most_rows_and_a_text_is_long(spark):
    rows = [("hot words in every text " * 3, "en", "hot")] * 300 + [("cold words in some texts", "en", f"c{i % 5}") for i in range(50)]
    rows += [("long tail " * 100_000 + "w" * 2_000_000, "en", "c1")]
    assert audited(spark, rows) == brute(rows)


def test_odd_documents_and_clashing_columns(spark):
    frame = docs_of(spark, ODD * 12)
    rows = [(r.text, r.lang, r.source) for r in frame.collect()]
    more = clashing(frame).withColumns({n: F.lit("x") for n in ("terms", "prefix", "number", "p", "value", "part")})
    assert Counter(tuple(r[n] for n in NAMES) for r in audit(more).collect()) == brute(rows)
    assert audit(frame.limit(0)).count() == 0


def test_query_equals_its_sql(spark):
    from tools.check_oracles import compare, duck

    for folder in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        verdict = compare(spark, duck(folder), folder, "op12", queries.op12_source_divergence, queries.ORACLES["op12_source_divergence"])
        assert verdict.startswith("ok"), verdict
