"""Outbound events and redacted views."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.functions.text import iso_instant, no_headers
from keyflow.functions.trace import inject_context, with_span
from keyflow.operators.classify import wire_status
from keyflow.operators.flags import FlagSettings, customer_flag
from keyflow.operators.upsert import instant


def publishable(
    outcomes: DataFrame, rules: DataFrame, settings: FlagSettings | None = None
) -> DataFrame:
    """Processed rows whose customer has publishing switched on; every one, not the last per customer."""
    done = outcomes.filter(F.col("outcome") == S.PROCESSED)
    flagged = customer_flag(
        done, rules, S.OUTBOUND_FLAG, S.OUTBOUND_FLAG_DEFAULT, settings=settings
    )
    return flagged.filter("flag_enabled").drop("flag_enabled")


def _outbound_fields(processed_at: datetime | str | Column) -> list[Column]:
    return [
        F.col("event.customerId").alias("customerId"),
        F.col("event.phoneNumber").alias("phoneNumber"),
        F.col("event.address").alias("address"),
        wire_status(F.col("outcome")).alias("status"),
        iso_instant(instant(processed_at)).alias("processedAt"),
        F.lit(S.PROCESSED).alias("reason"),
        F.col("topic").alias("inboundTopic"),
        F.col("partition").alias("inboundPartition"),
        F.col("offset").alias("inboundOffset"),
    ]


def outbound_events(processed: DataFrame, processed_at: datetime | str | Column) -> DataFrame:
    """The outbound event of every processed row, one column per field."""
    return processed.select(*_outbound_fields(processed_at))


def outbound_records(
    processed: DataFrame, processed_at: datetime | str | Column, topic: str = S.OUTBOUND_TOPIC
) -> DataFrame:
    """Outbound records: topic, key, headers with the trace context, and the event struct."""
    headers = inject_context(
        no_headers(),
        F.col("trace_id"),
        F.col("span_id"),
        F.col("sampled"),
        F.col("trace_state"),
        F.col("debug"),
    )
    return with_span(processed).select(
        F.lit(topic).alias("topic"),
        F.col("event.customerId").alias("key"),
        headers.alias("headers"),
        F.struct(*_outbound_fields(processed_at)).alias("event"),
    )


def redacted(rows: DataFrame) -> DataFrame:
    """Shared view: customer id in clear; phone and address with letters and digits masked."""
    event = F.col("event")
    address = F.struct(
        *[F.mask(event["address"][name]).alias(name) for name in S.ADDRESS.names]
    )
    masked = F.struct(
        event["customerId"].alias("customerId"),
        F.mask(event["phoneNumber"]).alias("phoneNumber"),
        F.when(event["address"].isNotNull(), address).alias("address"),
    )
    return rows.withColumn("event", F.when(event.isNotNull(), masked))
