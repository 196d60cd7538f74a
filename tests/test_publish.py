from conftest import ADDRESS, envelope, log_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.functions.text import last_header
from keyflow.operators import publish
from keyflow.plans.outcomes import build_outcomes
from keyflow.plans.testlog import flag_rules

AT = "2024-02-15 01:02:03.5"


def outcomes(spark, *rows):
    return build_outcomes(log_of(spark, list(rows)))


def test_every_processed_record_is_published_and_no_other(spark):
    rules = spark.createDataFrame([], S.FLAG_RULES)
    log = outcomes(
        spark, envelope("c", 1), envelope("c", 2), envelope("c", 2, arrival=1), envelope("", 3)
    )
    sent = publish.publishable(log, rules)
    assert sorted(r.offset for r in sent.collect()) == [1, 2]


def test_flag_off_skips_only_the_publish(spark):
    log = outcomes(spark, envelope("7", 33))
    assert [r.outcome for r in log.collect()] == [S.PROCESSED]
    assert publish.publishable(log, flag_rules(spark)).isEmpty()


def test_outbound_event(spark):
    log = outcomes(spark, envelope("cust-2", 21))
    row = publish.outbound_events(log, AT).first()
    assert row.asDict(recursive=True) == {
        "customerId": "cust-2",
        "phoneNumber": "555-0100",
        "address": dict(zip(S.ADDRESS.names, ADDRESS)),
        "status": "PROCESSED",
        "processedAt": "2024-02-15T01:02:03.500Z",
        "reason": "PROCESSED",
        "inboundTopic": "inbound",
        "inboundPartition": 0,
        "inboundOffset": 21,
    }
    assert publish.outbound_events(log, AT).columns == S.PROCESSED_EVENT.names


def test_outbound_record_is_keyed_and_carries_the_trace(spark):
    record = publish.outbound_records(outcomes(spark, envelope("cust-2", 21)), AT)
    row = record.select("*", last_header(F.col("headers"), "traceparent").alias("parent")).first()
    assert (row.topic, row.key) == (S.OUTBOUND_TOPIC, "cust-2")
    assert row.parent.startswith("00-") and len(row.parent) == 55


def test_redacted_view_keeps_only_the_id(spark):
    log = log_of(spark, [envelope("cust-9", address=("1 Main", "Austin", None, "78701")), envelope(null=True)])
    first, null = [r.event for r in publish.redacted(log).collect()]
    assert first.customerId == "cust-9" and first.phoneNumber == "nnn-nnnn"
    assert tuple(first.address) == ("n Xxxx", "Xxxxxx", None, "nnnnn")
    assert null is None
