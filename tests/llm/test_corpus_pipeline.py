import gc
import importlib
import sys
import weakref

import duckdb
import pytest
from llm.arrow_functions import recorded
from llm.docs_of import ODD, docs_of

import corpus_pipeline as cp
from keyflow.llm import near_copies
from keyflow.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def test_stages_on_the_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    first = cp.identify_language(spark, docs, SF_DIR)
    assert first.columns == docs.columns and first.count() >= 0.97 * docs.count()
    second = cp.drop_near_copies(spark, first, SF_DIR)
    assert second.columns == docs.columns
    classes = near_copies.classes(first, cp.NEAR_COPY)
    assert second.count() == classes.select("component_id").distinct().count()
    third = cp.cut_repeats(spark, second, SF_DIR)
    assert third.columns == docs.columns and third.count() == second.count()
    fourth = cp.drop_benchmark(spark, third, SF_DIR)
    assert fourth.columns == docs.columns
    items = [r.text for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").collect()]
    assert not [r for r in fourth.collect() if any(item in r.text for item in items)]
    last = cp.encode_tokens(spark, fourth, SF_DIR)
    texts = {r.doc_id: r.text for r in fourth.collect()}
    assert {r.doc_id: r.text for r in last.collect()} == texts


def test_run_keeps_types_and_odd_rows(spark, tmp_path):
    rows = [*ODD, (99, "12345 67890"), (98, "---")]
    docs_of(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.read.parquet(f"{SF_DIR}/benchmark.parquet").write.parquet(str(tmp_path / "benchmark.parquet"))
    found = cp.run(spark, str(tmp_path)).collect()
    assert {r.doc_id for r in found} == {1, 5, 6, 7, -8, None}
    docs_of(spark, []).write.mode("overwrite").parquet(str(tmp_path / "documents.parquet"))
    assert cp.run(spark, str(tmp_path)).count() == 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_queries_run(spark, name):
    frame = QUERIES[name](spark, SF_DIR)
    others = {"op5_nearest", "op6_chat", "op9_decontaminate", "op12_source_divergence", "op13_hard_negatives"}
    assert frame.count() > 0
    if name not in others:
        assert frame.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    if name in ORACLES:
        con = duckdb.connect()
        for table in ("documents", "conversations", "embeddings", "benchmark"):
            con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
        relation = con.execute(ORACLES[name])
        order = [c[0] for c in relation.description]
        assert sorted(map(tuple, frame.select(*order).collect())) == sorted(relation.fetchall())


def test_entry_has_them():
    entry = importlib.import_module("__spark_entry__")
    assert {*QUERIES, "pipeline"} <= entry.queries().keys()
    assert len([name for name in entry.queries() if name.startswith("op")]) == 13
    assert "keyflow.llm" in sys.modules


def test_a_worker_keeps_the_caches_of_one_operator():
    from keyflow.llm import common

    common.kept_by_worker("language m", "rows", dict)["word"] = b"row"
    assert common.kept_by_worker("language m", "rows", dict) == {"word": b"row"}
    common.alone("language m")
    assert common._kept == {"language m": {"rows": {"word": b"row"}}}
    common.alone("near copies")
    assert common._kept == {"near copies": {}}


def test_every_function_of_a_stage_drops_the_caches_of_others(spark, monkeypatch):
    from keyflow.llm import common

    functions = recorded(spark, monkeypatch)
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for stage in (cp.identify_language, cp.drop_near_copies, cp.drop_benchmark):
        stage(spark, docs, SF_DIR)
    assert len(functions) >= 8
    for function in functions:
        common.kept_by_worker("counts", "of another operator", dict)
        list(function(iter([])))
        assert "counts" not in common._kept, function


def test_tokens_are_encoded_and_decoded_by_one_worker(spark, monkeypatch):
    functions = recorded(spark, monkeypatch)
    docs = docs_of(spark, ODD)
    found = cp.encode_tokens(spark, docs, SF_DIR)
    assert len(functions) == 1
    both = cp.bpe.decode(cp.bpe.encode(docs, cp.BYTE_BPE), cp.BYTE_BPE)
    assert sorted(map(repr, found.select(both.columns).collect())) == sorted(map(repr, both.collect()))


def test_what_an_operator_kept_goes_at_once():
    from keyflow.llm import common

    machine = common.kept_by_worker("bpe", "of this test", lambda: cp.bpe.Automaton(cp.BYTE_BPE))
    assert machine.encode("some words") and machine.spaced.fill.__self__ is machine
    kept = weakref.ref(machine)
    del machine
    gc.disable()
    try:
        common.alone("near copies")
        assert kept() is None
    finally:
        gc.enable()


def test_a_task_of_decontamination_has_one_python_function(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    plan = cp.drop_benchmark(spark, docs, SF_DIR)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1
