"""The key memory's runs and the snapshot's buckets over many small batches."""

from pathlib import Path

from conftest import envelope, log_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.dedup import seen_keys, ttl_micros
from keyflow.plans.batch import Target, run_batch
from keyflow.plans.outcomes import build_outcomes
from keyflow.sources.memory import KEPT, KeyMemory
from keyflow.sources.tables import SnapshotTable, read_batches, read_range, write_batch

AT = "2024-02-15 00:00:00"
TTL = ttl_micros("7 days")


def folders(path, pattern="run-*"):
    return sorted(p.name for p in Path(path).glob(pattern))


def accepted(spark, rows):
    return build_outcomes(log_of(spark, rows)).filter(F.col("outcome") == S.PROCESSED)


def test_runs_stay_few_and_hold_every_live_key(spark, tmp_path):
    memory = KeyMemory(spark, str(tmp_path / "memory"), TTL, fan=3)
    most = 0
    for number in range(20):
        memory.add(number, accepted(spark, [envelope("a", number, number / 10, key=f"k{number % 13}")]))
        runs = memory.state_before(number + 1)[1]
        most = max(most, len(runs))
        levels = [run["level"] for run in runs]
        assert all(levels.count(level) < 3 for level in levels)
    assert most <= 6
    assert len(folders(memory.path)) <= 12 and len(memory.manifests.versions()) == 3
    known = seen_keys(memory.read(runs)).collect()
    assert {(r.dedup_key, r.offset) for r in known} == {(f"dedup:idemp:k{n % 13}", n) for n in range(7, 20)}


def test_expired_runs_are_neither_read_nor_kept(spark, tmp_path):
    memory = KeyMemory(spark, str(tmp_path / "memory"), TTL)
    for number, at in enumerate((0, 5, 13, 30)):
        memory.add(number, accepted(spark, [envelope("a", number, at, key=f"k{number}")]))
    runs = memory.state_before(3)[1]
    assert len(runs) == 3
    alive = memory.read(runs, runs[-1]["newest_us"] - TTL)
    assert [r.offset for r in alive.collect()] == [2] and alive.schema == KEPT
    assert len(memory.state_before(4)[1]) == 1
    assert memory.read([], 0) is None


def test_batches_of_one_long_stretch_remember_what_came_before_it(spark, tmp_path):
    """The first batch of a stretch of many TTLs must not expire what the others of it still need."""
    target = Target(str(tmp_path / "out"), spark.createDataFrame([], S.FLAG_RULES))
    batches = [[envelope("a", 0, 0, key="k")], [envelope("b", 1, 5), envelope("b", 2, 30)], [envelope("a", 3, 6, key="k"), envelope("a", 4, 29)]]
    for number, rows in enumerate(batches):
        run_batch(spark, log_of(spark, rows), target, number, AT)
    log = read_batches(spark, target.table("outcome_log"), S.OUTCOME)
    assert [r.offset for r in log.filter("outcome = 'DUPLICATE_SKIPPED'").collect()] == [3]
    assert target.memory(spark).state_before(3)[1]


def test_empty_batches_and_repeats_leave_no_folder(spark, tmp_path):
    memory = KeyMemory(spark, str(tmp_path / "memory"), TTL)
    memory.add(0, accepted(spark, []))
    assert memory.state_before(1) == (0, []) and not folders(memory.path)
    for _ in range(3):
        memory.add(1, accepted(spark, [envelope("a", 1, 1)]))
    assert len(folders(memory.path)) == 1
    for number in range(2, 6):
        memory.add(number, accepted(spark, []))
    assert memory.state_before(2) is None


def test_memory_takes_over_what_the_log_has(spark, tmp_path):
    """A log written without the memory, and an old batch run again when its state is gone."""
    target = Target(str(tmp_path / "out"), spark.createDataFrame([], S.FLAG_RULES))
    first = build_outcomes(log_of(spark, [envelope("a", 0, 0, key="k")]))
    write_batch(first, target.table("outcome_log"), 0)
    for number in range(1, 7):
        run_batch(spark, log_of(spark, [envelope("a", number, number / 10, key="k"), envelope("b", 50 + number, number / 10)]), target, number, AT)
    log = read_batches(spark, target.table("outcome_log"), S.OUTCOME)
    skipped = log.filter("outcome = 'DUPLICATE_SKIPPED'").orderBy("batch_id")
    assert [r.offset for r in skipped.collect()] == [1, 2, 3, 4, 5, 6]
    assert target.memory(spark).state_before(2) is None
    run_batch(spark, log_of(spark, [envelope("a", 2, 0.2, key="k"), envelope("b", 52, 0.2)]), target, 2, AT)
    assert [r.offset for r in skipped.collect()] == [1, 2, 3, 4, 5, 6]


def test_a_range_of_batches(spark, tmp_path):
    path = str(tmp_path / "log")
    for number in (0, 3, 4, 500):
        write_batch(build_outcomes(log_of(spark, [envelope("a", number)])), path, number)
    for first, last, want in [(0, 3, [0, 3]), (1, 2, None), (4, 1000, [4, 500]), (3, 2, None)]:
        rows = read_range(spark, path, S.OUTCOME, first, last)
        assert (rows and sorted(r.batch_id for r in rows.collect())) == want


def documents(spark, names, offset):
    rows = [(name, str(offset), None, None, "t", 0, offset, None, None) for name in names]
    return spark.createDataFrame(rows, S.CUSTOMER)


def test_small_merges_rewrite_only_the_buckets_they_touch(spark, tmp_path):
    snapshot = SnapshotTable(spark, str(tmp_path / "customers"), buckets=16)
    names = [f"c{n}" for n in range(200)]
    snapshot.replace(documents(spark, names, 0), 0)
    assert len(snapshot.written_by(0)) == 16
    rewritten = []
    for version in range(1, 21):
        assert snapshot.merge(documents(spark, [f"c{version}", f"new{version}"], version), version)
        rewritten.append(sum(writer == version for writer in snapshot.written_by(version).values()))
    assert all(1 <= n <= 2 for n in rewritten)
    held = {r.customerId: r.lastInboundOffset for r in snapshot.read().collect()}
    assert held == {name: 0 for name in names} | {f"{kind}{n}": n for n in range(1, 21) for kind in ("c", "new")}
    assert snapshot.versions() == [18, 19, 20]
    stored = {tuple(int(part.partition("=")[2]) for part in p.relative_to(snapshot.path).parts) for p in Path(snapshot.path).glob("version=*/_bucket=*")}
    named = {(writer, bucket) for version in snapshot.versions() for bucket, writer in snapshot.written_by(version).items()}
    assert stored == named
    assert not snapshot.merge(documents(spark, ["c1"], 99), 20)


def test_a_merge_without_updates_and_into_nothing(spark, tmp_path):
    snapshot = SnapshotTable(spark, str(tmp_path / "customers"))
    assert snapshot.merge(documents(spark, [], 0), 0) and snapshot.read().isEmpty()
    assert snapshot.merge(documents(spark, ["a", "b"], 1), 1)
    assert snapshot.merge(documents(spark, [], 2), 2)
    assert sorted(r.customerId for r in snapshot.read().collect()) == ["a", "b"]
