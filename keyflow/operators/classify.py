"""Validation, dedup key and outcome of every delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.functions.keys import dedup_key, idempotency_header
from keyflow.functions.text import has_text

NULL_PAYLOAD = "null payload"
NO_PLACE = "missing topic, partition or offset"
NO_ARRIVAL = "missing arrival time"


def is_null_payload(event: Column) -> Column:
    return event.isNull()


def invalid_reason(event: Column) -> Column:
    """The first required part that is missing, or null for a valid event. Address parts are free."""
    return (
        F.when(is_null_payload(event), F.lit(NULL_PAYLOAD))
        .when(~has_text(event["customerId"]), F.lit("missing customerId"))
        .when(~has_text(event["phoneNumber"]), F.lit("missing phoneNumber"))
        .when(event["address"].isNull(), F.lit("missing address"))
    )


def is_valid(event: Column) -> Column:
    return invalid_reason(event).isNull()


def failure_reason() -> Column:
    """Why a delivery fails before dedup, or null. Without a place it has no identity, without an arrival no order."""
    placed = F.col("topic").isNotNull() & F.col("partition").isNotNull() & F.col("offset").isNotNull()
    return (
        F.when(~placed, F.lit(NO_PLACE))
        .when(F.col("arrival_ts").isNull(), F.lit(NO_ARRIVAL))
        .otherwise(invalid_reason(F.col("event")))
    )


def with_dedup_key(envelopes: DataFrame) -> DataFrame:
    """Add ``dedup_key``; the header is looked up once per row."""
    key = dedup_key(F.col("topic"), F.col("partition"), F.col("offset"), F.col("idempotency_key"))
    return with_idempotency_key(envelopes).withColumn("dedup_key", key)


def with_idempotency_key(envelopes: DataFrame) -> DataFrame:
    return envelopes.withColumn("idempotency_key", idempotency_header(F.col("headers")))


def failed_rows(envelopes: DataFrame) -> DataFrame:
    """Null and invalid payloads and records without place or arrival: they fail before dedup and mark no key."""
    reason = failure_reason()
    return envelopes.filter(reason.isNotNull()).withColumns(
        {
            "outcome": F.lit(S.FAILED),
            "reason": reason,
            "dedup_reason": F.lit(None).cast("string"),
        }
    )


def valid_rows(envelopes: DataFrame) -> DataFrame:
    return envelopes.filter(failure_reason().isNull())


def marked_outcome(marked: DataFrame) -> DataFrame:
    """Turn the ``accepted`` mark of dedup into an outcome."""
    return marked.withColumns(
        {
            "outcome": F.when(F.col("accepted"), S.PROCESSED).otherwise(S.DUPLICATE_SKIPPED),
            "reason": F.when(F.col("accepted"), S.PROCESSED).otherwise(
                F.concat(F.lit("duplicate by "), F.col("dedup_reason"))
            ),
        }
    ).drop("accepted")


def needs_retry(outcome: Column) -> Column:
    return outcome.isin(S.FAILED, S.LOCK_NOT_ACQUIRED)


def wire_status(outcome: Column) -> Column:
    """Outbound spelling of an outcome; null for the one that has no outbound symbol."""
    status = F.lit(None).cast("string")
    for name, symbol in S.WIRE_STATUS.items():
        status = F.when(outcome == name, F.lit(symbol)).otherwise(status)
    return status
