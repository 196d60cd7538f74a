"""Every registered query against its SQL oracle on the smallest tables, and the fixture counts."""

import pytest

import __spark_entry__ as entry
from keyflow.operators import reports
from keyflow.plans import catalog
from keyflow.plans.oracles import ORACLES
from tools.check_oracles import compare, duck

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert set(catalog.QUERIES) == set(ORACLES)
    assert set(catalog.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_query_equals_oracle(spark, con, name):
    verdict = compare(spark, con, SF_DIR, name, entry.queries()[name], entry.oracle_sql()[name])
    assert verdict.startswith("ok"), verdict


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_fixture_counts(spark):
    counts = {r.outcome: r.n for r in catalog.outcome_log(spark, SF_DIR).groupBy("outcome").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()}
    assert counts == {"PROCESSED": 942, "DUPLICATE_SKIPPED": 164, "FAILED": 34}
    state = reports.commit_state(catalog._polls(spark, SF_DIR)).groupBy("committed", "redelivered").count()
    got = {(r.committed, r.redelivered): r["count"] for r in state.collect()}
    assert got == {(True, False): 704, (False, True): 267, (False, False): 29}

def test_counts_of_both_streams_come_from_one_landing(spark, monkeypatch):
    landed, land = [], catalog._land
    monkeypatch.setattr(catalog, "_land", lambda log, path: landed.append(path) or land(log, path))
    found = catalog.live_counts(spark, SF_DIR).collect()
    assert len(landed) == 1 and {r.memory for r in found} == {"log", "state"}
    counts = {(r.memory, r.outcome): r.records for r in found}
    assert all(counts["log", outcome] == counts["state", outcome] for _, outcome in counts)
