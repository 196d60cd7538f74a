import pytest
from conftest import envelope, header, log_of
from pyspark.sql import functions as F

from keyflow.functions import trace
from keyflow.functions.text import last_header, no_headers

TRACE, SPAN = "0af7651916cd43dd8448eb211c80319c", "b7ad6b7169203331"
OTHER, OTHER_SPAN = "1" * 32, "2" * 16
W3C = header("traceparent", f"00-{TRACE}-{SPAN}-01")


def context(spark, headers):
    row = log_of(spark, [envelope(headers=headers)]).select(trace.extract_context(F.col("headers"))).first()
    return None if row[0] is None else (row[0].trace_id, row[0].span_id, row[0].sampled, row[0].source)


@pytest.mark.parametrize(
    "headers, want",
    [
        ([], None),
        ([W3C], (TRACE, SPAN, True, "w3c")),
        ([header("traceparent", f"00-{TRACE}-{SPAN}-00")], (TRACE, SPAN, False, "w3c")),
        ([header("traceparent", f"ff-{TRACE}-{SPAN}-01")], None),
        ([header("traceparent", f"00-{TRACE}-{SPAN}-01-extra")], None),
        ([header("traceparent", f"01-{TRACE}-{SPAN}-01-extra")], (TRACE, SPAN, True, "w3c")),
        ([header("traceparent", f"00-{'0' * 32}-{SPAN}-01")], None),
        ([header("traceparent", f"00-{TRACE}-{'0' * 16}-01")], None),
        ([header("traceparent", "junk")], None),
        ([header("b3", f"{TRACE}-{SPAN}-1")], (TRACE, SPAN, True, "b3")),
        ([header("b3", f"{TRACE}-{SPAN}-d")], (TRACE, SPAN, True, "b3")),
        ([header("b3", f"{TRACE}-{SPAN}")], (TRACE, SPAN, False, "b3")),
        ([header("b3", f"{SPAN}-{SPAN}-0-{SPAN}")], ("0" * 16 + SPAN, SPAN, False, "b3")),
        ([header("b3", "0")], None),
        (
            [header("X-B3-TraceId", TRACE), header("X-B3-SpanId", SPAN), header("X-B3-Sampled", "1")],
            (TRACE, SPAN, True, "b3-multi"),
        ),
        ([header("X-B3-TraceId", TRACE)], None),
        ([W3C, header("b3", f"{OTHER}-{OTHER_SPAN}-1")], (OTHER, OTHER_SPAN, True, "b3")),
        ([W3C, header("b3", "junk")], (TRACE, SPAN, True, "w3c")),
        (
            [header("b3", f"{OTHER}-{OTHER_SPAN}"), header("X-B3-TraceId", TRACE), header("X-B3-SpanId", SPAN)],
            (OTHER, OTHER_SPAN, False, "b3"),
        ),
    ],
)
def test_extract(spark, headers, want):
    assert context(spark, headers) == want


@pytest.mark.parametrize(
    "headers, debug",
    [
        ([header("b3", f"{TRACE}-{SPAN}-d")], True),
        ([header("b3", f"{TRACE}-{SPAN}-1")], False),
        ([header("X-B3-TraceId", TRACE), header("X-B3-SpanId", SPAN), header("X-B3-Flags", "1")], True),
        ([header("X-B3-TraceId", TRACE), header("X-B3-SpanId", SPAN), header("X-B3-Sampled", "1")], False),
        ([W3C], False),
    ],
)
def test_debug_goes_on(spark, headers, debug):
    span = trace.with_span(log_of(spark, [envelope(headers=headers)]))
    names = ("trace_id", "span_id", "sampled", "trace_state", "debug")
    sent = span.withColumn("sent", trace.inject_context(F.col("headers"), *map(F.col, names)))
    values = [last_header(F.col("sent"), name).alias(name) for name in ("b3", "X-B3-Flags", "X-B3-Sampled")]
    row = sent.select("sampled", *values).first()
    assert row.sampled is True and row["X-B3-Sampled"] == "1"
    assert row["X-B3-Flags"] == ("1" if debug else None)
    assert row["b3"].endswith("-d" if debug else "-1")


def test_child_span_keeps_trace_and_tags(spark):
    rows = [envelope(offset=5, headers=[W3C]), envelope(offset=6), envelope(offset=7)]
    spans = {r.offset: r for r in trace.with_span(log_of(spark, rows)).collect()}
    child = spans[5]
    assert (child.trace_id, child.parent_span_id) == (TRACE, SPAN)
    assert len(child.span_id) == 16 and child.span_id != SPAN
    assert child.span_name == "customer.ingest.process"
    assert child.tags == {
        "messaging.system": "kafka",
        "messaging.destination": "inbound",
        "messaging.kafka.partition": "0",
        "messaging.kafka.offset": "5",
    }
    assert spans[6].parent_span_id is None and spans[6].trace_id != spans[7].trace_id
    assert len(spans[6].trace_id) == 32


def test_injected_context_extracts_again(spark):
    span = trace.with_span(log_of(spark, [envelope(headers=[W3C, header("tracestate", "a=b")])]))
    headers = trace.inject_context(
        no_headers(), F.col("trace_id"), F.col("span_id"), F.col("sampled"), F.col("trace_state")
    )
    sent = span.withColumn("sent", headers)
    row = sent.select(
        trace.w3c_context(F.col("sent")).alias("w3c"),
        trace.b3_single_context(F.col("sent")).alias("single"),
        trace.b3_multi_context(F.col("sent")).alias("multi"),
        last_header(F.col("sent"), "tracestate").alias("state"),
        "span_id",
    ).first()
    for found in (row.w3c, row.single, row.multi):
        assert (found.trace_id, found.span_id, found.sampled) == (TRACE, row.span_id, True)
    assert row.state == "a=b"
