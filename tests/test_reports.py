import random

import pytest
from conftest import envelope, log_of

from keyflow import schemas as S
from keyflow.operators import numbering, reports
from keyflow.plans.outcomes import build_outcomes

LOG = "topic string, partition int, offset bigint, outcome string"


def outcome_rows(spark, outcomes, start=0, step=1):
    rows = [("in", 0, start + step * n, outcome) for n, outcome in enumerate(outcomes)]
    return spark.createDataFrame(rows, LOG)


def test_prefix_before_the_first_failure_is_committed(spark):
    outcomes = [S.PROCESSED] * 25
    outcomes[3], outcomes[7] = S.FAILED, S.LOCK_NOT_ACQUIRED
    polls = reports.poll_batches(outcome_rows(spark, outcomes))
    rows = {r.idx: r for r in reports.commit_state(polls).collect()}
    assert [i for i in range(25) if rows[i].committed] == [0, 1, 2]
    assert [i for i in range(25) if rows[i].redelivered] == [4, 5, 6, *range(8, 25)]
    retry = reports.first_retryable(polls).first()
    assert (retry.size, retry.first_retry) == (25, 3)


def test_clean_poll_is_committed_whole_and_the_next_starts_fresh(spark):
    outcomes = [S.PROCESSED] * 25 + [S.FAILED] + [S.DUPLICATE_SKIPPED] * 3
    state = reports.commit_state(reports.poll_batches(outcome_rows(spark, outcomes, 100, 7)))
    assert state.filter("committed").count() == 25
    assert sorted(r.idx for r in state.filter("redelivered").collect()) == [1, 2, 3]
    empty = reports.first_retryable(reports.poll_batches(outcome_rows(spark, outcomes))).orderBy("poll")
    assert [(r.size, r.first_retry) for r in empty.collect()] == [(25, None), (4, 0)]


@pytest.mark.parametrize("slice_size", [1, 10, 100_000])
def test_offset_numbers_over_gaps_and_slices(spark, slice_size):
    rng = random.Random(3)
    rows = [("t", p, o, "") for p in range(3) for o in rng.sample(range(1000), 60)]
    got = numbering.offset_numbers(spark.createDataFrame(rows, LOG), "n", slice_size).collect()
    want = {
        (p, o): n for p in range(3) for n, o in enumerate(sorted(r[2] for r in rows if r[1] == p))
    }
    assert {(r.partition, r.offset): r.n for r in got} == want


@pytest.mark.parametrize("most", [0, numbering.MAX_BROADCAST_RUNS])
def test_staged_numbers_in_any_order_with_a_large_group(spark, monkeypatch, most):
    monkeypatch.setattr(numbering, "MAX_BROADCAST_RUNS", most)
    rows = [(0 if n % 3 else n % 5, (n * 7919) % 1000, n) for n in range(900)]
    frame = spark.createDataFrame(rows, "g int, a int, b int").repartition(6)
    got = numbering.staged_numbers(frame, "g", ["a", "b"], "n").collect()
    assert len(got) == len(rows)
    for group in {r[0] for r in rows}:
        ordered = sorted((r.a, r.b) for r in got if r.g == group)
        assert [(r.a, r.b) for r in sorted((r for r in got if r.g == group), key=lambda r: r.n)] == ordered
        assert sorted(r.n for r in got if r.g == group) == list(range(len(ordered)))


def test_first_delivery_counts_not_the_skip(spark):
    log = build_outcomes(log_of(spark, [envelope(offset=1), envelope(offset=1, arrival=2), envelope(offset=1)]))
    rows = reports.first_deliveries(log).collect()
    assert [(r.offset, r.outcome) for r in rows] == [(1, S.PROCESSED)]


def test_counts(spark):
    log = build_outcomes(log_of(spark, [envelope(offset=1), envelope(offset=1, arrival=2), envelope("", 2)]))
    got = {(r.partition, r.outcome): r.records for r in reports.outcome_counts(log).collect()}
    assert got == {(0, S.PROCESSED): 1, (0, S.DUPLICATE_SKIPPED): 1, (0, S.FAILED): 1}


def test_customers_that_queue_for_one_lock(spark):
    second = 1 / 86_400
    rows = [envelope("a", 0), envelope("a", 1, 9 * second), envelope("a", 2, 11 * second), envelope("b", 3)]
    got = reports.hot_customers(log_of(spark, rows)).collect()
    assert [(r.customerId, r.records) for r in got] == [("a", 2)]
    assert reports.hot_customers(log_of(spark, rows), "1 minute").first().records == 3
