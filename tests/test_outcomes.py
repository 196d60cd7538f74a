"""Classification and dedup of single records, one case per rule."""

import pytest
from conftest import ADDRESS, envelope, log_of, outcomes_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators import classify
from keyflow.operators.dedup import seen_keys
from keyflow.plans.outcomes import build_outcomes

P, D, X = S.PROCESSED, S.DUPLICATE_SKIPPED, S.FAILED


@pytest.mark.parametrize(
    "over, reason",
    [
        ({"null": True}, "null payload"),
        ({"customer": None}, "missing customerId"),
        ({"customer": ""}, "missing customerId"),
        ({"customer": " \t"}, "missing customerId"),
        ({"phone": None}, "missing phoneNumber"),
        ({"phone": " "}, "missing phoneNumber"),
        ({"address": None}, "missing address"),
    ],
)
def test_invalid_records_fail(spark, over, reason):
    row = build_outcomes(log_of(spark, [envelope(**over)])).first()
    assert (row.outcome, row.reason) == (X, reason)


def test_address_parts_are_not_checked(spark):
    rows = [envelope(address=(None, "", " ", None))]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [P]


def test_same_offset_again_is_skipped(spark):
    rows = [envelope(offset=15, arrival=0), envelope(offset=15, arrival=1)]
    got = build_outcomes(log_of(spark, rows)).orderBy("arrival_ts").collect()
    assert [(r.outcome, r.dedup_reason) for r in got] == [(P, None), (D, "offset")]
    assert got[1].dedup_key == "dedup:offset:inbound:0:15"


def test_header_alone_is_a_duplicate(spark):
    rows = [envelope(offset=1, key="biz-1"), envelope(offset=2, arrival=1, key="biz-1", partition=1)]
    got = build_outcomes(log_of(spark, rows)).orderBy("arrival_ts").collect()
    assert [(r.outcome, r.dedup_reason) for r in got] == [(P, None), (D, "idempotency-key")]


def test_header_is_not_scoped_by_customer_or_topic(spark):
    rows = [
        envelope("a", 1, 0, key="biz"),
        envelope("b", 2, 1, key="biz"),
        envelope("c", 3, 2, key="biz", topic="elsewhere"),
    ]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [P, D, D]


def test_blank_header_is_ignored(spark):
    rows = [envelope(offset=1, key=" "), envelope(offset=2, arrival=1, key=" ")]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [P, P]


def test_ttl_runs_from_the_last_accepted_record(spark):
    rows = [envelope(offset=n, arrival=n, key="k") for n in (0, 4, 8, 14, 15)]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [P, D, P, D, P]


def test_exactly_one_ttl_later_is_accepted(spark):
    micro = 1 / 86_400_000_000
    rows = [envelope(offset=0, key="k"), envelope(offset=1, arrival=7 - micro, key="k"), envelope(offset=2, arrival=7, key="k")]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [P, D, P]


def test_invalid_record_delivered_twice_fails_twice_and_marks_nothing(spark):
    rows = [
        envelope("", 1, 0, key="k"),
        envelope("", 1, 1, key="k"),
        envelope("ok", 2, 2, key="k"),
    ]
    assert outcomes_of(build_outcomes(log_of(spark, rows))) == [X, X, P]


@pytest.mark.parametrize("floor", [1, 1000])
def test_exact_copies_leave_one_accepted(spark, floor):
    rows = [envelope(offset=3)] * 5 + [envelope(offset=4)]
    got = sorted(outcomes_of(build_outcomes(log_of(spark, rows), floor=floor)))
    assert got == [D, D, D, D, P, P]


@pytest.mark.parametrize("floor", [1, 1000])
def test_keys_of_earlier_runs_count(spark, floor):
    before = build_outcomes(log_of(spark, [envelope(offset=0, key="k"), envelope(offset=9)]))
    seen = seen_keys(before.filter(F.col("outcome") == P))
    rows = [
        envelope(offset=0, key="k"),  # the same delivery once more
        envelope(offset=1, arrival=3, key="k"),
        envelope(offset=2, arrival=7, key="k"),
        envelope(offset=3, arrival=8, key="k"),
        envelope(offset=9, arrival=1),
    ]
    got = build_outcomes(log_of(spark, rows), seen=seen, floor=floor).orderBy("offset").collect()
    assert [(r.outcome, r.dedup_reason) for r in got] == [
        (D, "offset"),
        (D, "idempotency-key"),
        (P, None),
        (D, "idempotency-key"),
        (D, "offset"),
    ]


def test_empty_log(spark):
    assert build_outcomes(log_of(spark, [])).count() == 0


def test_retry_and_wire_status(spark):
    frame = spark.createDataFrame([(o,) for o in S.OUTCOMES], "outcome string")
    outcome = F.col("outcome")
    got = frame.select(outcome, classify.needs_retry(outcome), classify.wire_status(outcome)).collect()
    assert {r[0]: (r[1], r[2]) for r in got} == {
        "PROCESSED": (False, "PROCESSED"),
        "DUPLICATE_SKIPPED": (False, "SKIPPED_DUPLICATE"),
        "LOCK_NOT_ACQUIRED": (True, None),
        "FAILED": (True, "FAILED"),
    }


def test_payload_travels_with_the_outcome(spark):
    row = build_outcomes(log_of(spark, [envelope("cust-2", 21)]), batch_id=4).first()
    assert tuple(row.event.address) == ADDRESS
    assert (row.batch_id, row.key) == (4, "record-key")
