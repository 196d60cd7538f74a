"""Named queries over the driver tables: one per operator, each over the whole log."""

from __future__ import annotations

from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from keyflow import schemas as S
from keyflow.functions import trace as trace_headers
from keyflow.functions.keys import idempotency_key, offset_key
from keyflow.functions.text import has_text, header_names, iso_instant, last_header, no_headers, set_header, set_headers
from keyflow.functions.trace import extract_context, with_span
from keyflow.operators import classify, dedup, flags, publish, reports, upsert
from keyflow.operators.skew import lookup_join
from keyflow.plans.batch import Target, quarantine_rows, replay_rows, run_batch, together
from keyflow.plans.batch import live_counts as batch_counts
from keyflow.plans.outcomes import build_outcomes
from keyflow.plans.testlog import flag_history, flag_rules, inbound_log, landed_log, old_snapshot, unplaced_log
from keyflow.session import scratch_path, use_utc
from keyflow.sources.codecs import decode, encode
from keyflow.sources.envelopes import read_log, stream_log
from keyflow.sources.tables import read_batches
from keyflow.streaming import live
from keyflow.streaming.pipeline import run_stream

PROCESSED_AT = "2024-02-15 00:00:00"
APPLICATION = "keyflow"
SLICES = 4
FILES_PER_BATCH = 1
HEAVY_ROWS = 3
#: Bytes of a row group of landed files: what one task reads at least, so that several read a large file.
ROW_GROUP = 8 * 1024 * 1024
_written: dict[tuple[str, str], DataFrame] = {}
PLACE = ["topic", "partition", "offset", "arrival_us"]


def _place(rows: DataFrame) -> DataFrame:
    return rows.withColumn("arrival_us", F.unix_micros("arrival_ts"))


def _event_columns(event: Column | None = None) -> list[Column]:
    event = F.col("event") if event is None else event
    address = event["address"]
    return [
        event["customerId"].alias("customer_id"),
        event["phoneNumber"].alias("phone"),
        *[address[name].alias(name) for name in S.ADDRESS.names],
    ]


def _log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return landed_log(use_utc(spark), sf_dir)


def _outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return build_outcomes(_log(spark, sf_dir))


def _failed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify.failed_rows(classify.with_dedup_key(_log(spark, sf_dir)))


def _done(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcomes(spark, sf_dir).filter(F.col("outcome") == S.PROCESSED)


def _documents(rows: DataFrame, *extra: str) -> DataFrame:
    return rows.select(
        F.col("customerId").alias("customer_id"),
        F.col("phoneNumber").alias("phone"),
        *[F.col(f"address.{name}").alias(name) for name in S.ADDRESS.names],
        iso_instant(F.col("updatedAt")).alias("updated_at"),
        F.col("lastInboundTopic").alias("last_topic"),
        F.col("lastInboundPartition").alias("last_partition"),
        F.col("lastInboundOffset").alias("last_offset"),
        F.unix_micros("lastInboundTimestamp").alias("last_timestamp_us"),
        *extra,
    )


def _outcome_view(rows: DataFrame) -> DataFrame:
    return _place(rows).select(*PLACE, "dedup_key", "outcome", "reason", "dedup_reason")


def inbound_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = offset_key(F.col("topic"), F.col("partition"), F.col("offset"))
    return _place(inbound_log(use_utc(spark), sf_dir)).select(
        *PLACE,
        F.unix_micros("timestamp").alias("timestamp_us"),
        "key",
        key.alias("offset_key"),
        F.size("headers").alias("headers"),
        *_event_columns(),
    )


def payload_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events to bytes and back; a record without an event carries a broken payload."""
    payload = F.coalesce(encode(F.col("event")), F.lit(b'{"customerId": "cut'))
    rows = _place(_log(spark, sf_dir)).withColumn("value", payload)
    return rows.withColumn("event", decode(F.col("value"))).select(
        *PLACE, F.col("event").isNull().alias("undecodable"), *_event_columns()
    )


def payload_validity(spark: SparkSession, sf_dir: str) -> DataFrame:
    event = F.col("event")
    return _place(_log(spark, sf_dir)).select(
        *PLACE,
        classify.is_null_payload(event).alias("is_null"),
        classify.is_valid(event).alias("is_valid"),
        classify.invalid_reason(event).alias("reason"),
    )


def idempotency_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.with_dedup_key(_place(_log(spark, sf_dir)))
    header = F.col("idempotency_key")
    return rows.select(
        *PLACE,
        "idempotency_key",
        has_text(header).alias("has_key"),
        idempotency_key(header).alias("header_key"),
        "dedup_key",
    )


def header_edits(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = F.col("headers")
    edited = set_header(headers, S.IDEMPOTENCY_HEADER, F.concat(F.lit("new-"), F.col("key")))
    return _place(_log(spark, sf_dir)).select(
        *PLACE,
        F.array_join(header_names(headers), ",").alias("names"),
        F.array_join(header_names(edited), ",").alias("edited_names"),
        last_header(edited, S.IDEMPOTENCY_HEADER).alias("edited_value"),
    )


def dedup_first_wins(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.valid_rows(classify.with_dedup_key(_log(spark, sf_dir)))
    return dedup.first_wins(rows)


def dedup_ttl(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = classify.valid_rows(classify.with_dedup_key(_log(spark, sf_dir)))
    marked = dedup.ttl_dedup(rows.select("topic", "partition", "offset", "arrival_ts", "dedup_key"))
    return _place(marked).select(*PLACE, "dedup_key", "accepted", "dedup_reason")


def seen_membership(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every delivery against the last accepted one of its key: is that memory alive, or over?"""
    rows = classify.with_dedup_key(_place(_log(spark, sf_dir)))
    seen = dedup.seen_keys(_done(spark, sf_dir))
    expires = F.unix_micros("arrival_ts") + dedup.ttl_micros(S.DEDUP_TTL)
    lookup = seen.select("dedup_key", expires.alias("expires_us"))
    joined = lookup_join(rows.select(*PLACE, "dedup_key"), lookup, "dedup_key")
    known = F.col("expires_us").isNotNull()
    return joined.select(
        *PLACE, "dedup_key", known.alias("known"), "expires_us",
        F.coalesce(F.col("expires_us") > F.col("arrival_us"), F.lit(False)).alias("alive"),
    )


def outcome_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _outcome_view(_outcomes(spark, sf_dir)).withColumn(
        "status", classify.wire_status(F.col("outcome"))
    )


def duplicate_skips(spark: SparkSession, sf_dir: str) -> DataFrame:
    skipped = _outcomes(spark, sf_dir).filter(F.col("outcome") == S.DUPLICATE_SKIPPED)
    return _place(skipped).select(*PLACE, "dedup_key", "dedup_reason")


def customer_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _documents(upsert.latest_per_customer(_done(spark, sf_dir), PROCESSED_AT))


def customer_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = _done(spark, sf_dir)
    keys = done.groupBy(F.col("event.customerId").alias("customerId")).agg(
        F.count(F.lit(1)).alias("writes")
    )
    found = upsert.lookup_documents(keys, old_snapshot(spark, sf_dir))
    return found.select(
        F.col("customerId").alias("customer_id"),
        "writes",
        "is_insert",
        F.col("document.phoneNumber").alias("stored_phone"),
        F.col("document.address.city").alias("stored_city"),
    )


def snapshot_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    updates = upsert.latest_per_customer(_done(spark, sf_dir), PROCESSED_AT)
    return _documents(upsert.merge_snapshot(old_snapshot(spark, sf_dir), updates), "is_insert")


def flag_evaluation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _log(spark, sf_dir)
    flagged = flags.customer_flag(rows, flag_rules(spark), S.OUTBOUND_FLAG, S.OUTBOUND_FLAG_DEFAULT)
    context = flags.customer_context(F.col("event.customerId"))
    return _place(flagged).select(
        *PLACE,
        context.alias("context_key"),
        flags.rollout_bucket(S.OUTBOUND_FLAG, context).alias("bucket"),
        "flag_enabled",
    )


def flag_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The publishing flag as it was when each record came in, with both ways of joining the rules' history."""
    rows, history = _log(spark, sf_dir), flag_history(spark)
    ways = {"broadcast": {}, "sorted": {"max_broadcast": 0, "floor": HEAVY_ROWS}}
    views = []
    for way, limits in ways.items():
        flagged = flags.customer_flag_at(rows, history, S.OUTBOUND_FLAG, S.OUTBOUND_FLAG_DEFAULT, **limits)
        views.append(_place(flagged).select(*PLACE, "flag_enabled", F.lit(way).alias("way")))
    return reduce(DataFrame.unionByName, views)


def flag_app_scope(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = flag_rules(spark)
    offline = flags.FlagSettings(sdk_key=S.PLACEHOLDER_SDK_KEY)
    rows = _log(spark, sf_dir)
    for name, flag, default, settings in [
        ("known_flag", S.OUTBOUND_FLAG, False, None),
        ("unknown_flag", "my-flag", False, None),
        ("offline_flag", S.OUTBOUND_FLAG, False, offline),
    ]:
        rows = flags.application_flag(
            rows, rules, flag, default, APPLICATION, settings=settings, name=name
        )
    return _place(rows).select(*PLACE, "known_flag", "unknown_flag", "offline_flag")


def outbound_processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    sent = publish.publishable(_outcomes(spark, sf_dir), flag_rules(spark))
    events = publish.outbound_events(sent, PROCESSED_AT)
    return events.select(
        F.col("customerId").alias("customer_id"),
        F.col("phoneNumber").alias("phone"),
        *[F.col(f"address.{name}").alias(name) for name in S.ADDRESS.names],
        "status",
        F.col("processedAt").alias("processed_at"),
        "reason",
        F.col("inboundTopic").alias("inbound_topic"),
        F.col("inboundPartition").alias("inbound_partition"),
        F.col("inboundOffset").alias("inbound_offset"),
    )


def outbound_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outbound records as they go on the wire: key, encoded value, trace headers."""
    sent = publish.publishable(_outcomes(spark, sf_dir), flag_rules(spark))
    records = publish.outbound_records(sent, PROCESSED_AT)
    context = extract_context(F.col("headers"))
    return records.select(
        "topic",
        "key",
        encode(F.col("event")).cast("string").alias("value"),
        F.array_join(header_names(F.col("headers")), ",").alias("header_names"),
        last_header(F.col("headers"), "traceparent").alias("traceparent"),
        last_header(F.col("headers"), "b3").alias("b3"),
        context["trace_id"].alias("trace_id"),
        context["sampled"].alias("sampled"),
    )


def pii_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _place(publish.redacted(_log(spark, sf_dir))).select(*PLACE, *_event_columns())


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Failure is decided before dedup, so this needs no shuffle."""
    held = quarantine_rows(_failed(spark, sf_dir))
    return _place(held).select(*PLACE, "outcome", "reason", *_event_columns())


def _polls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Polls over the written outcome log: numbering reads it twice, so dedup must not be in it."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = scratch_path(spark, "outcomes")
        narrow = _outcomes(spark, sf_dir).select("topic", "partition", "offset", "arrival_ts", "outcome")
        narrow.write.parquet(path)
        _written[key] = spark.read.schema(narrow.schema).parquet(path)
    return reports.poll_batches(reports.first_deliveries(_written[key]))


def poll_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _polls(spark, sf_dir).select("topic", "partition", "offset", "poll", "idx", "outcome")


def first_retryable(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.first_retryable(_polls(spark, sf_dir))


def committable_prefix(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = reports.commit_state(_polls(spark, sf_dir))
    return state.filter("committed").select("topic", "partition", "offset", "poll", "idx")


def redelivery_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = reports.commit_state(_polls(spark, sf_dir))
    return state.filter("redelivered").select("topic", "partition", "offset", "poll", "idx")


def outcome_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports.outcome_counts(_outcomes(spark, sf_dir))


def hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers with more than one valid record in an hour."""
    hot = reports.hot_customers(classify.valid_rows(_log(spark, sf_dir)), "1 hour")
    return hot.select(
        F.col("customerId").alias("customer_id"),
        F.unix_micros("window_start").alias("window_start_us"),
        "records",
    )


def trace_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = F.array_join(F.map_values("tags"), "|").alias("tags")
    return _place(with_span(_log(spark, sf_dir))).select(
        *PLACE, "trace_id", "parent_span_id", "span_id", "sampled", "span_name", tags
    )


def trace_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contexts in several B3 headers, with short ids, debug, not sampled, malformed: read, and written again by the child span."""
    place = F.concat_ws("|", "topic", F.col("partition").cast("string"), F.col("offset").cast("string"))
    form, trace, span = F.col("offset") % 4, F.md5(F.concat(F.lit("t|"), place)), F.substring(F.md5(F.concat(F.lit("s|"), place)), 1, 16)
    values = {
        trace_headers.B3_TRACE_ID: F.when(form == 1, F.substring(trace, 1, 16)).otherwise(trace),
        trace_headers.B3_SPAN_ID: F.when(form == 3, F.substring(span, 1, 8)).otherwise(span),
        trace_headers.B3_SAMPLED: F.when(form == 0, "1").when(form == 1, "0"),
        trace_headers.B3_FLAGS: F.when(form == 2, "1"),
        trace_headers.TRACEPARENT: F.when(form >= 2, F.concat(F.lit("00-"), F.md5(F.concat(F.lit("w|"), place)), F.lit("-"), span, F.lit("-01"))),
    }
    rows = _place(_log(spark, sf_dir)).withColumn("headers", set_headers(no_headers(), values))
    spans = with_span(rows)
    written = trace_headers.inject_context(*(F.col(x) for x in ("headers", "trace_id", "span_id", "sampled", "trace_state", "debug")))
    spans = spans.withColumn("headers", written)
    return spans.select(
        *PLACE, "trace_id", "parent_span_id", "span_id", "sampled", "debug",
        *(last_header(F.col("headers"), name).alias(alias) for name, alias in (("b3", "b3"), ("X-B3-Flags", "flags"), ("traceparent", "traceparent"))),
    )


def _arrival_slices(log: DataFrame, slices: int = SLICES) -> list[DataFrame]:
    """The log cut by arrival time, in order, into about equal slices; rows without one are in the first.

    Every slice is read several times, so the log is written once by slices, and a slice reads its own files alone."""
    spark, arrival = log.sparkSession, F.unix_micros("arrival_ts")
    cuts = log.agg(F.percentile_approx(arrival, [n / slices for n in range(1, slices)], 10_000)).first()[0] or []
    number = F.lit(0)
    for cut in cuts:
        number = number + F.coalesce((arrival >= cut).cast("int"), F.lit(0))
    path = scratch_path(spark, "slices")
    log.withColumn("_slice", number).write.partitionBy("_slice").parquet(path)
    whole = spark.read.schema(T.StructType([*log.schema, T.StructField("_slice", T.IntegerType())])).parquet(path)
    return [whole.filter(F.col("_slice") == n).drop("_slice") for n in range(slices)]


def _run_batches(spark: SparkSession, log: DataFrame, target: Target, first: int = 0) -> None:
    for number, part in enumerate(_arrival_slices(log)):
        run_batch(spark, part, target, first + number, PROCESSED_AT)


def batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log through the batch pipeline in slices of arrival time; result: the outcome log."""
    target = Target(scratch_path(use_utc(spark), "batch"), flag_rules(spark))
    _run_batches(spark, _log(spark, sf_dir), target)
    return _outcome_view(read_batches(spark, target.table("outcome_log"), S.OUTCOME))


def batch_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer snapshot the batch pipeline leaves on top of the old one."""
    target = Target(scratch_path(use_utc(spark), "batch"), flag_rules(spark))
    target.snapshot(spark).replace(old_snapshot(spark, sf_dir), 0)
    _run_batches(spark, _log(spark, sf_dir), target, 1)
    return _documents(target.snapshot(spark).read())


def _land(log: DataFrame, path: str) -> None:
    """Land a log in arrival order: slice by slice, and within one all records of a key in the same file, so files of a
    slice may be read in any order."""
    for part in _arrival_slices(log):
        keyed = classify.with_dedup_key(part).repartition("dedup_key")
        keyed.select(*S.ENVELOPE.names).write.mode("append").option("parquet.block.size", ROW_GROUP).parquet(path)


def _drain(spark: SparkSession, log: DataFrame, memory: str, **bound: int) -> Target:
    """The log landed and drained by one stream with a bounded intake."""
    target = Target(scratch_path(use_utc(spark), "stream"), flag_rules(spark))
    _land(log, target.table("landing"))
    return _drain_landed(spark, target.table("landing"), target, memory, **bound)


def _drain_landed(spark: SparkSession, landing: str, target: Target, memory: str, **bound: int) -> Target:
    run_stream(spark, stream_log(spark, landing, **bound), target, PROCESSED_AT, memory)
    return target


def stream_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream with keyed state; result: the outcome log."""
    target = _drain(spark, _log(spark, sf_dir), "state")
    return _outcome_view(read_batches(spark, target.table("outcome_log"), S.OUTCOME))


def stream_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log as a stream of large micro-batches that remember through the outcome log."""
    target = _drain(spark, _log(spark, sf_dir), "log")
    return _outcome_view(read_batches(spark, target.table("outcome_log"), S.OUTCOME))


def stream_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same log, a few files per micro-batch, so that several micro-batches remember each other's keys."""
    target = _drain(spark, _log(spark, sf_dir), "log", max_files=FILES_PER_BATCH)
    return _outcome_view(read_batches(spark, target.table("outcome_log"), S.OUTCOME))


def _finish(query: StreamingQuery) -> StreamingQuery:
    try:
        query.awaitTermination()
    finally:
        query.stop()
    return query


def stream_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old snapshot kept up to date by a stream over the outcome log, some files at a time."""
    target = Target(scratch_path(use_utc(spark), "documents"), flag_rules(spark))
    build_outcomes(_log(spark, sf_dir)).drop("batch_id").write.parquet(f"{target.table('outcome_log')}/batch_id=0")
    snapshot = target.snapshot(spark)
    snapshot.replace(old_snapshot(spark, sf_dir), 0)
    outcomes = live.stream_outcome_log(spark, target.table("outcome_log"), FILES_PER_BATCH * 2)
    _finish(live.start_documents(outcomes, snapshot, target.table("checkpoint"), PROCESSED_AT))
    return _documents(snapshot.read())


def live_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``hot_keys`` as a stream over the landed log with windows that stay open long enough for all records."""
    path = scratch_path(use_utc(spark), "hot")
    _land(_log(spark, sf_dir), f"{path}/landing")
    records = classify.valid_rows(stream_log(spark, f"{path}/landing"))
    _finish(live.start_hot_customers(records, f"{path}/counts", f"{path}/checkpoint", "1 hour", "60 days"))
    return live.hot_so_far(spark, f"{path}/counts").select(
        F.col("customerId").alias("customer_id"), F.unix_micros("window_start").alias("window_start_us"), "records"
    )


def live_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the counters of a bounded stream and of a stream with keyed state say, summed over their micro-batches.

    The log is landed once for both, and they drain it at the same time: one's small jobs leave cores to the other."""
    landing = scratch_path(use_utc(spark), "landing")
    _land(_log(spark, sf_dir), landing)
    bounds = {"log": {"max_files": FILES_PER_BATCH}, "state": {}}
    targets = {memory: Target(scratch_path(spark, "stream"), flag_rules(spark)) for memory in bounds}
    together(*(partial(_drain_landed, spark, landing, targets[memory], memory, **bound) for memory, bound in bounds.items()))
    views = []
    for memory, target in targets.items():
        totals = batch_counts(spark, target).groupBy("outcome").agg(F.sum("records").alias("records"))
        views.append(totals.withColumn("memory", F.lit(memory)))
    return reduce(DataFrame.unionByName, views)


def dedup_ttl_heavy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TTL dedup with keys taken for heavy from a few rows on: the walk over blocks gives what the fold gives."""
    rows = classify.valid_rows(classify.with_dedup_key(_log(spark, sf_dir)))
    marked = dedup.ttl_dedup(rows, floor=HEAVY_ROWS)
    return _place(marked).select(*PLACE, "dedup_key", "accepted", "dedup_reason")


def unplaced_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records that lack arrival, time or offset, each way to dedup: one outcome per record, whatever the way."""
    path = scratch_path(use_utc(spark), "unplaced")
    unplaced_log(_log(spark, sf_dir)).write.parquet(path)
    log = read_log(spark, path)
    ways = {"fold": build_outcomes(log), "walk": build_outcomes(log, floor=HEAVY_ROWS)}
    for memory in ("log", "state"):
        target = _drain(spark, log, memory)
        ways[memory] = read_batches(spark, target.table("outcome_log"), S.OUTCOME)
    views = [_outcome_view(rows).withColumn("way", F.lit(way)) for way, rows in ways.items()]
    return reduce(DataFrame.unionByName, views)


def _sink_keys(spark: SparkSession, target: Target, way: str) -> DataFrame:
    """Keys and row counts of all sinks of a pipeline."""
    place = F.concat_ws("|", "topic", "partition", "offset", F.unix_micros("arrival_ts"))
    logs = [
        read_batches(spark, target.table(name), S.OUTCOME).select(F.lit(name).alias("sink"), place.alias("key"))
        for name in ("outcome_log", "quarantine")
    ]
    outbound = spark.read.parquet(target.table("outbound")).select(F.lit("outbound").alias("sink"), "key")
    customers = target.snapshot(spark).read().select(F.lit("customers").alias("sink"), F.col("customerId").alias("key"))
    rows = reduce(DataFrame.unionByName, [*logs, outbound, customers])
    return rows.groupBy("sink", "key").agg(F.count(F.lit(1)).alias("records")).withColumn("way", F.lit(way))


def redelivery_repeat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every batch run twice, and a stream started again where it ended: what the sinks hold, with counts."""
    log = _log(spark, sf_dir)
    batches = Target(scratch_path(use_utc(spark), "batch"), flag_rules(spark))
    for number, part in enumerate(_arrival_slices(log)):
        for _ in range(2):
            run_batch(spark, part, batches, number, PROCESSED_AT)
    stream = _drain(spark, log, "log")
    run_stream(spark, stream_log(spark, stream.table("landing")), stream, PROCESSED_AT)
    return _sink_keys(spark, batches, "batch").unionByName(_sink_keys(spark, stream, "stream"))


def landed_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quarantined records landed again and replayed: all of them fail again."""
    path = scratch_path(use_utc(spark), "replay")
    replay_rows(quarantine_rows(_failed(spark, sf_dir))).write.parquet(path)
    return _outcome_view(build_outcomes(read_log(spark, path), batch_id=1))


QUERIES = {
    query.__name__: query
    for query in [
        inbound_envelope,
        payload_codec,
        payload_validity,
        idempotency_header,
        header_edits,
        dedup_first_wins,
        dedup_ttl,
        seen_membership,
        outcome_log,
        duplicate_skips,
        customer_upsert,
        customer_lookup,
        snapshot_merge,
        flag_evaluation,
        flag_as_of,
        flag_app_scope,
        outbound_processed,
        outbound_messages,
        pii_redacted,
        quarantine,
        poll_batches,
        first_retryable,
        committable_prefix,
        redelivery_set,
        outcome_counts,
        hot_keys,
        trace_columns,
        trace_forms,
        batch_outcomes,
        batch_snapshot,
        stream_outcomes,
        stream_backfill,
        stream_bounded,
        live_counts,
        stream_snapshot,
        live_hot_keys,
        dedup_ttl_heavy,
        unplaced_records,
        redelivery_repeat,
        landed_replay,
    ]
}
