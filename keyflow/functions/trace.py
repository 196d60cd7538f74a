"""Trace context in record headers: W3C ``traceparent``, B3 single and B3 multi."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.functions.text import last_header, set_headers

# Header names, span name and tag names.
TRACEPARENT = "traceparent"
TRACESTATE = "tracestate"
B3_SINGLE = "b3"
B3_TRACE_ID = "X-B3-TraceId"
B3_SPAN_ID = "X-B3-SpanId"
B3_SAMPLED = "X-B3-Sampled"
B3_FLAGS = "X-B3-Flags"
SPAN_NAME = "customer.ingest.process"
TAG_SYSTEM = "messaging.system"
TAG_DESTINATION = "messaging.destination"
TAG_PARTITION = "messaging.kafka.partition"
TAG_OFFSET = "messaging.kafka.offset"
SYSTEM = "kafka"

_W3C = r"^([0-9a-f]{2})-([0-9a-f]{32})-([0-9a-f]{16})-([0-9a-f]{2})(-.*)?$"
_B3 = r"^([0-9a-f]{32}|[0-9a-f]{16})-([0-9a-f]{16})(?:-([01d]))?(?:-[0-9a-f]{16})?$"
_TRACE_ID = r"^([0-9a-f]{32}|[0-9a-f]{16})$"
_SPAN_ID = r"^[0-9a-f]{16}$"


def _context(
    valid: Column, trace: Column, span: Column, sampled: Column, source: str, debug: Column | None = None
) -> Column:
    """A context struct, or null unless the ids are well formed and not all zero."""
    nonzero = trace.rlike("[^0]") & span.rlike("[^0]")
    fields = F.struct(
        F.lpad(trace, 32, "0").alias("trace_id"),
        span.alias("span_id"),
        F.coalesce(sampled, F.lit(False)).alias("sampled"),
        F.lit(source).alias("source"),
        F.coalesce(F.lit(False) if debug is None else debug, F.lit(False)).alias("debug"),
    )
    return F.when(F.coalesce(valid & nonzero, F.lit(False)), fields)


def w3c_context(headers: Column) -> Column:
    value = last_header(headers, TRACEPARENT)

    def part(group):
        return F.regexp_extract(value, _W3C, group)

    version = part(1)
    valid = value.rlike(_W3C) & (version != "ff") & ((version != "00") | (part(5) == ""))
    # the sampled bit is the lowest bit of the flags
    sampled = F.substring(part(4), 2, 1).isin("1", "3", "5", "7", "9", "b", "d", "f")
    return _context(valid, part(2), part(3), sampled, "w3c")


def b3_single_context(headers: Column) -> Column:
    value = last_header(headers, B3_SINGLE)

    def part(group):
        return F.regexp_extract(value, _B3, group)

    return _context(value.rlike(_B3), part(1), part(2), part(3).isin("1", "d"), "b3", part(3) == "d")


def b3_multi_context(headers: Column) -> Column:
    trace, span = last_header(headers, B3_TRACE_ID), last_header(headers, B3_SPAN_ID)
    valid = trace.rlike(_TRACE_ID) & span.rlike(_SPAN_ID)
    debug = F.coalesce(last_header(headers, B3_FLAGS) == "1", F.lit(False))
    sampled = debug | last_header(headers, B3_SAMPLED).isin("1", "true")
    return _context(valid, trace, span, sampled, "b3-multi", debug)


def extract_context(headers: Column) -> Column:
    """The remote parent. A valid B3 context replaces a W3C one; the single header comes first."""
    return F.coalesce(
        b3_single_context(headers), b3_multi_context(headers), w3c_context(headers)
    )


def with_span(rows: DataFrame) -> DataFrame:
    """Add the child span of every record: trace and parent ids, own id, name, tags.

    Ids that a tracer would draw at random are hashes of the record's place in the log, so a replay
    gives the same ids.
    """
    place = F.concat_ws("|", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    parent = F.col("_parent")
    trace_id = F.coalesce(parent["trace_id"], F.substring(F.sha2(F.concat(F.lit("trace|"), place), 256), 1, 32))
    span_id = F.substring(F.sha2(F.concat_ws("|", trace_id, place), 256), 1, 16)
    state = F.when(parent["source"] == "w3c", last_header(F.col("headers"), TRACESTATE))
    tags = F.create_map(
        F.lit(TAG_SYSTEM), F.lit(SYSTEM),
        F.lit(TAG_DESTINATION), F.col("topic"),
        F.lit(TAG_PARTITION), F.col("partition").cast("string"),
        F.lit(TAG_OFFSET), F.col("offset").cast("string"),
    )
    return (
        rows.withColumn("_parent", extract_context(F.col("headers")))
        .withColumns(
            {
                "trace_id": trace_id,
                "parent_span_id": parent["span_id"],
                "span_id": span_id,
                "sampled": F.coalesce(parent["sampled"], F.lit(True)),
                "debug": F.coalesce(parent["debug"], F.lit(False)),
                "trace_state": state,
                "span_name": F.lit(SPAN_NAME),
                "tags": tags,
            }
        )
        .drop("_parent")
    )


def inject_context(
    headers: Column,
    trace_id: Column,
    span_id: Column,
    sampled: Column,
    trace_state: Column,
    debug: Column | None = None,
) -> Column:
    """Write the current span into the headers in all three forms, replacing what was there.

    ``debug`` is B3's stronger form of sampled: ``d`` in the single header, a flag of its own among the others.
    """
    debug = F.lit(False) if debug is None else debug
    flag = F.when(sampled | debug, F.lit("1")).otherwise(F.lit("0"))
    values = {
        TRACEPARENT: F.concat(F.lit("00-"), trace_id, F.lit("-"), span_id, F.lit("-0"), flag),
        TRACESTATE: trace_state,
        B3_TRACE_ID: trace_id,
        B3_SPAN_ID: span_id,
        B3_SAMPLED: flag,
        B3_FLAGS: F.when(debug, F.lit("1")),
        B3_SINGLE: F.concat_ws("-", trace_id, span_id, F.when(debug, F.lit("d")).otherwise(flag)),
    }
    return set_headers(headers, values)
