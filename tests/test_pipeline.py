"""Batch and stream pipelines: replays, memory across runs, equality of the two."""

from pathlib import Path

import pytest
from conftest import envelope, log_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.classify import with_dedup_key
from keyflow.plans import batch
from keyflow.plans.batch import Target, merge_pending, replay_rows, run_batch
from keyflow.plans.catalog import _arrival_slices
from keyflow.plans.outcomes import build_outcomes
from keyflow.session import shared_folder
from keyflow.sources.envelopes import stream_log
from keyflow.sources.tables import SnapshotTable, read_batches
from keyflow.streaming.dedup_state import HASHED, stream_first_wins, unit_of
from keyflow.streaming.pipeline import run_stream, start_stream

AT = "2024-02-15 00:00:00"
FIRST = [
    envelope("a", 0, 0, key="k1"),
    envelope("b", 1, 1),
    envelope("", 2, 2),
    envelope("a", 3, 3, key="k1"),
    envelope("c", 4, 4, null=True),
]
SECOND = [
    envelope("a", 3, 5, key="k1"),
    envelope("b", 1, 6),
    envelope("a", 5, 7, key="k1"),
    envelope("b", 6, 8, phone="555-0199"),
]
VIEW = ["topic", "partition", "offset", "arrival_ts", "dedup_key", "outcome", "reason", "dedup_reason"]


@pytest.fixture
def target(spark, tmp_path):
    return Target(str(tmp_path / "out"), spark.createDataFrame([], S.FLAG_RULES))


def table(spark, target, name, schema=S.OUTCOME):
    return read_batches(spark, target.table(name), schema)


def state(spark, target):
    """Everything the sinks hold, as sorted text."""
    outbound = spark.read.parquet(target.table("outbound"))
    frames = [
        table(spark, target, "outcome_log"),
        table(spark, target, "quarantine"),
        outbound,
        target.snapshot(spark).read(),
    ]
    return [sorted(str(row) for row in frame.collect()) for frame in frames]


def same_rows(left, right):
    left, right = left.select(*VIEW), right.select(*VIEW)
    return left.exceptAll(right).isEmpty() and right.exceptAll(left).isEmpty()


def test_batches_remember_and_replays_change_nothing(spark, target):
    run_batch(spark, log_of(spark, FIRST), target, 0, AT)
    run_batch(spark, log_of(spark, SECOND), target, 1, AT)
    once = state(spark, target)
    whole = build_outcomes(log_of(spark, FIRST + SECOND))
    assert same_rows(table(spark, target, "outcome_log"), whole)
    outbound = spark.read.parquet(target.table("outbound"))
    assert outbound.count() == whole.filter(F.col("outcome") == S.PROCESSED).count()
    held = table(spark, target, "quarantine")
    assert sorted((r.offset, r.reason) for r in held.collect()) == [
        (2, "missing customerId"),
        (4, "null payload"),
    ]
    customers = {r.customerId: (r.lastInboundOffset, r.phoneNumber) for r in target.snapshot(spark).read().collect()}
    assert customers == {"a": (5, "555-0100"), "b": (6, "555-0199")}
    run_batch(spark, log_of(spark, SECOND), target, 1, AT)
    assert state(spark, target) == once
    again = build_outcomes(replay_rows(table(spark, target, "quarantine")))
    assert {r.outcome for r in again.collect()} == {S.FAILED}


def test_merges_can_be_shared_by_several_batches(spark, tmp_path):
    rules = spark.createDataFrame([], S.FLAG_RULES)
    target = Target(str(tmp_path / "out"), rules, merge_every=2)
    run_batch(spark, log_of(spark, FIRST), target, 0, AT)
    assert target.snapshot(spark).read().isEmpty()
    run_batch(spark, log_of(spark, SECOND), target, 1, AT)
    assert {r.customerId: r.lastInboundOffset for r in target.snapshot(spark).read().collect()} == {"a": 5, "b": 6}
    assert merge_pending(spark, target, 1, AT) is False


def test_snapshot_survives_a_write_that_never_finished(spark, tmp_path):
    snapshot = SnapshotTable(spark, str(tmp_path / "customers"))
    assert snapshot.read().isEmpty()
    row = ("a", "1", None, None, None, None, None, None, None)
    snapshot.replace(spark.createDataFrame([row], S.CUSTOMER), 4)
    broken = spark.createDataFrame([("half", *row[1:])], S.CUSTOMER)
    broken.write.parquet(snapshot.folder(5))
    assert snapshot.current() == 4
    assert [r.customerId for r in snapshot.read().collect()] == ["a"]


def test_readers_keep_their_version(spark, tmp_path):
    snapshot = SnapshotTable(spark, str(tmp_path / "customers"), keep=2)
    row = (None,) * 8
    for version in range(4):
        snapshot.replace(spark.createDataFrame([(f"v{version}", *row)], S.CUSTOMER), version)
        if version == 2:
            reader = snapshot.read()
    assert snapshot.versions() == [2, 3]
    assert [r.customerId for r in reader.collect()] == ["v2"]
    assert [r.customerId for r in snapshot.read().collect()] == ["v3"]


def test_a_catalog_table_gets_only_the_changes(spark, tmp_path, monkeypatch):
    """MERGE itself needs a table format that is not here; what it is given is."""
    given = []
    monkeypatch.setattr(batch, "merge_into", lambda updates, name: given.append((name, sorted(r.customerId for r in updates.collect()))))
    target = Target(str(tmp_path / "out"), spark.createDataFrame([], S.FLAG_RULES), customers="lake.customers")
    run_batch(spark, log_of(spark, FIRST), target, 0, AT)
    run_batch(spark, log_of(spark, SECOND[2:3]), target, 1, AT)
    assert given == [("lake.customers", ["a", "b"]), ("lake.customers", ["a"])]
    assert target.snapshot(spark).current() == -1


def test_scratch_does_not_grow(spark, target):
    folder = Path(shared_folder(spark)) / "keyflow"
    before = None
    for number in range(3):
        run_batch(spark, log_of(spark, FIRST), target, number, AT)
        now = sorted(folder.iterdir()) if folder.exists() else []
        assert before is None or now == before
        before = now


@pytest.mark.parametrize("memory", ["state", "log"])
def test_stream_equals_batch_over_a_restart(spark, target, memory):
    landing = target.table("landing")
    for part in (FIRST, SECOND):
        log_of(spark, part).write.mode("append").parquet(landing)
        run_stream(spark, stream_log(spark, landing), target, AT, memory, timeout=300)
    whole = build_outcomes(log_of(spark, FIRST + SECOND))
    assert same_rows(table(spark, target, "outcome_log"), whole)
    assert {r.customerId: r.lastInboundOffset for r in target.snapshot(spark).read().collect()} == {"a": 5, "b": 6}
    assert spark.read.parquet(target.table("outbound")).count() == 4


def test_stream_ttl_and_copies(spark, target):
    rows = [envelope("a", n, n, key="k") for n in (0, 4, 8, 14, 15)] + [envelope("b", 99)] * 3
    landing = target.table("landing")
    log_of(spark, rows).write.parquet(landing)
    run_stream(spark, stream_log(spark, landing), target, AT, "state", timeout=300)
    assert same_rows(table(spark, target, "outcome_log"), build_outcomes(log_of(spark, rows)))


def test_neighbouring_offsets_share_a_state(spark):
    """The handler is called for units of keys: 1,000 neighbours of a partition, or keys of headers by their hash."""
    offsets = with_dedup_key(log_of(spark, [envelope("a", n) for n in (0, 7, 999, 1000, 1999, 2000, 123456, 123999)]))
    units = {r.offset: r.unit for r in offsets.select("offset", unit_of(F.col("dedup_key")).alias("unit")).collect()}
    assert units[0] == units[7] == units[999] and units[1000] == units[1999] and units[123456] == units[123999]
    assert len(set(units.values())) == 4
    headers = with_dedup_key(log_of(spark, [envelope("a", n, key=f"key-{n}") for n in range(3000)]))
    assert headers.select(unit_of(F.col("dedup_key"))).distinct().count() <= HASHED


def test_units_of_state_over_a_restart(spark, target):
    """Keys of one unit, and header keys of one group, keep their own places over micro-batches."""
    landing, parts = target.table("landing"), []
    for turn, days in enumerate((0, 3, 8)):
        plain = [envelope("a", n, days + n / 1000, partition=n % 2) for n in range(turn, 1200, turn + 1)]
        keyed = [envelope("b", 5000 + n, days + n / 1000, key=f"{n % 70}") for n in range(0, 300, turn + 1)]
        parts += plain + keyed
        log_of(spark, plain + keyed).write.mode("append").parquet(landing)
        run_stream(spark, stream_log(spark, landing), target, AT, "state", timeout=300)
    assert same_rows(table(spark, target, "outcome_log"), build_outcomes(log_of(spark, parts)))


def test_stream_first_wins(spark, target):
    landing = target.table("landing")
    rows = [envelope("a", 1), envelope("a", 1, 1), envelope("a", 2, 2)]
    log_of(spark, rows).write.parquet(landing)
    stream = stream_first_wins(with_dedup_key(stream_log(spark, landing)))
    query = (
        stream.writeStream.format("parquet")
        .option("path", target.table("firsts"))
        .option("checkpointLocation", target.table("checkpoint"))
        .trigger(availableNow=True)
        .start()
    )
    try:
        assert query.awaitTermination(300)
    finally:
        query.stop()
    assert sorted(r.offset for r in spark.read.parquet(target.table("firsts")).collect()) == [1, 2]


def test_always_on_stream(spark, target):
    """State with processing-time cleanup marks like a replay."""
    landing = target.table("landing")
    log_of(spark, FIRST).write.parquet(landing)
    query = start_stream(spark, stream_log(spark, landing), target, always_on=True, memory="state", interval="1 second")
    try:
        query.processAllAvailable()
        log_of(spark, SECOND).write.mode("append").parquet(landing)
        query.processAllAvailable()
    finally:
        query.stop()
    whole = build_outcomes(log_of(spark, FIRST + SECOND))
    assert same_rows(table(spark, target, "outcome_log"), whole)
    assert {r.customerId for r in target.snapshot(spark).read().collect()} == {"a", "b"}


def test_slices_read_their_own_files(spark):
    """A slice is read several times, so it must not read the rows of the others."""
    log = log_of(spark, [envelope("a", n, n / 10) for n in range(40)] + [envelope("b", 40 + n) for n in range(3)])
    parts = _arrival_slices(log)
    assert sum(part.count() for part in parts) == 43
    ends = [part.agg(F.min("arrival_ts"), F.max("arrival_ts")).first() for part in parts]
    assert all(before[1] < after[0] for before, after in zip(ends[:-1], ends[1:], strict=True))
    for part in parts:
        files = part.select(F.input_file_name().alias("file")).distinct().collect()
        assert len({Path(r.file).parent.name for r in files}) == 1
        assert "PartitionFilters: [isnotnull(_slice" in part._jdf.queryExecution().executedPlan().toString()
    assert _arrival_slices(log.limit(0))[0].isEmpty()


def test_drain_catches_up_with_shared_merges(spark, tmp_path):
    target = Target(str(tmp_path / "out"), spark.createDataFrame([], S.FLAG_RULES), merge_every=100)
    landing = target.table("landing")
    log_of(spark, FIRST).write.parquet(landing)
    run_stream(spark, stream_log(spark, landing), target, AT, "log", timeout=300)
    assert {r.customerId for r in target.snapshot(spark).read().collect()} == {"a", "b"}


def test_unknown_memory(spark, target):
    with pytest.raises(ValueError):
        start_stream(spark, None, target, memory="elsewhere")
