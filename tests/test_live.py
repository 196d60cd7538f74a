"""Live documents and live hot customers against their batch forms."""

from conftest import envelope, log_of
from pyspark.sql import functions as F

from keyflow.operators.reports import hot_customers
from keyflow.operators.upsert import latest_per_customer
from keyflow.plans.outcomes import build_outcomes
from keyflow.sources.envelopes import stream_log
from keyflow.sources.tables import SnapshotTable, write_batch
from keyflow.streaming import live

AT = "2024-02-15 00:00:00"


def finished(query):
    try:
        assert query.awaitTermination(300)
    finally:
        query.stop()
    return query


def test_documents_change_batch_by_batch(spark, tmp_path):
    log, snapshot = str(tmp_path / "log"), SnapshotTable(spark, str(tmp_path / "customers"), buckets=8)
    batches = [
        [envelope("a", 1, 1), envelope("b", 2, 2), envelope("", 3, 3)],
        [envelope("a", 5, 5, phone="555-0199"), envelope("a", 1, 9, at=1)],
        [envelope("c", 6, 6)],
    ]
    rows = []
    for number, batch in enumerate(batches):
        rows += batch
        write_batch(build_outcomes(log_of(spark, batch)), log, number)
        finished(live.start_documents(live.stream_outcome_log(spark, log), snapshot, str(tmp_path / "checkpoint"), AT, before=-1))
        done = build_outcomes(log_of(spark, rows)).filter("outcome = 'PROCESSED'")
        want = latest_per_customer(done, AT).collect()
        assert sorted(map(str, snapshot.read().collect())) == sorted(map(str, want))
    assert snapshot.current() == 2
    assert sorted(snapshot.written_by(2).values()).count(2) == 1


def test_hot_customers_grow_and_late_records_are_counted(spark, tmp_path):
    landing, path = str(tmp_path / "landing"), str(tmp_path / "counts")
    hour = 1 / 24
    first = [envelope("a", n, n * hour / 4) for n in range(6)] + [envelope("b", 50, 0.0)]
    second = [envelope("b", 51, hour / 2), envelope("a", 52, 3.0), envelope("a", 53, 3.001)]
    late = [envelope("a", 60, 0.01), envelope("c", 61, 3.0), envelope("c", 62, 3.0)]
    later = [envelope("a", 70, 0.012), envelope("d", 71, 3.1)]
    for part in (first, second, late, later):
        log_of(spark, part).coalesce(1).write.mode("append").parquet(landing)
        query = finished(live.start_hot_customers(stream_log(spark, landing), path, str(tmp_path / "checkpoint"), "1 hour", "2 hours"))
    assert live.late_records(query) == 1
    want = hot_customers(log_of(spark, first + second + late + later[1:]), "1 hour")
    got = live.hot_so_far(spark, path)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert {(r.customerId, r.records) for r in want.select("customerId", F.col("records")).collect()} == {("a", 5), ("a", 2), ("b", 2), ("c", 2)}
