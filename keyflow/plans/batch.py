"""The batch pipeline: a log in, outcome log, snapshot, outbound events and quarantine out."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from contextvars import copy_context
from dataclasses import dataclass
from datetime import datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.classify import needs_retry
from keyflow.operators.dedup import seen_keys, ttl_micros
from keyflow.operators.flags import FlagSettings
from keyflow.operators.publish import outbound_records, publishable
from keyflow.operators.upsert import latest_per_customer
from keyflow.plans.outcomes import build_outcomes
from keyflow.session import scratch_run
from keyflow.sources.manifests import Manifests
from keyflow.sources.memory import KeyMemory
from keyflow.sources.tables import (
    BUCKETS,
    SnapshotTable,
    merge_into,
    read_batch,
    read_if_present,
    read_range,
    to_kafka_rows,
    write_batch,
    write_kafka,
)


@dataclass(frozen=True)
class Target:
    """Where a pipeline writes, and how it publishes.

    A merge rewrites the snapshot's ``buckets`` that it touches; with small batches ``merge_every`` lets several batches
    share one. Nothing is lost in between: a merge takes all batches the snapshot does not have yet.
    With ``customers``, the name of a catalog table that supports MERGE, each batch changes only the
    documents it has.
    """

    path: str
    rules: DataFrame
    settings: FlagSettings | None = None
    ttl: str = S.DEDUP_TTL
    codec: str = "json"
    schema_id: int | None = None
    kafka_options: dict[str, str] | None = None
    merge_every: int = 1
    customers: str | None = None
    buckets: int = BUCKETS

    def table(self, name: str) -> str:
        return f"{self.path.rstrip('/')}/{name}"

    def snapshot(self, spark: SparkSession) -> SnapshotTable:
        return SnapshotTable(spark, self.table("customers"), buckets=self.buckets)

    def memory(self, spark: SparkSession) -> KeyMemory:
        return KeyMemory(spark, self.table("memory"), ttl_micros(self.ttl))


def _oldest_us(rows: DataFrame) -> int | None:
    return rows.agg(F.min(F.unix_micros("arrival_ts"))).first()[0]


def remembered_keys(
    spark: SparkSession, target: Target, batch_id: int, envelopes: DataFrame
) -> DataFrame | None:
    """Keys accepted by earlier batches that can still matter to this one; None without any.

    They come from the key memory, which first takes over batches of the outcome log that it has not seen. Only a batch so
    old that the memory's state before it is gone reads them from the outcome log.
    """
    memory = target.memory(spark)
    state = memory.state_before(batch_id)
    if state is not None:
        unseen = read_range(spark, target.table("outcome_log"), S.OUTCOME, state[0] + 1, batch_id - 1)
        if unseen is not None:
            memory.add(batch_id - 1, unseen.filter(F.col("outcome") == S.PROCESSED), _oldest_us(unseen))
            state = memory.state_before(batch_id)
        if not state[1]:
            return None
    oldest = _oldest_us(envelopes)
    alive_us = None if oldest is None else oldest - ttl_micros(target.ttl)
    if state is not None:
        earlier = memory.read(state[1], alive_us)
    else:
        log = read_if_present(spark, target.table("outcome_log"), S.OUTCOME)
        earlier = log and log.filter((F.col("batch_id") < batch_id) & (F.col("outcome") == S.PROCESSED))
    if earlier is None:
        return None
    if alive_us is not None:
        earlier = earlier.filter(F.col("arrival_ts") > F.timestamp_micros(F.lit(alive_us)))
    return seen_keys(earlier)


def together(*actions: Callable[[], object]) -> None:
    """Run independent writes at the same time: each is a few small jobs, which leave most of a cluster idle one by one.

    All of them end before an error of one is raised.
    """
    with ThreadPoolExecutor(len(actions)) as pool:
        running = [pool.submit(copy_context().run, inheritable_thread_target(action)) for action in actions]
    for action in running:
        action.result()


def write_sinks(
    spark: SparkSession, target: Target, batch_id: int, processed_at: datetime, remember: bool = False, oldest_us: int | None = None
) -> None:
    """Derive every other sink from one batch of the outcome log, and with ``remember`` the key memory; safe to repeat.

    ``oldest_us`` is the first arrival of the batch, for the memory.

    Publishing follows the durable log, so a failure in between repeats it instead of losing it.
    """
    log = read_batch(spark, target.table("outcome_log"), S.OUTCOME, batch_id)
    processed = log.filter(F.col("outcome") == S.PROCESSED)

    def customers() -> None:
        if target.customers is not None:
            merge_into(latest_per_customer(processed, processed_at), target.customers)
        elif (batch_id + 1) % target.merge_every == 0:
            merge_pending(spark, target, batch_id, processed_at)

    def outbound() -> None:
        records = outbound_records(publishable(log, target.rules, target.settings), processed_at)
        if target.kafka_options is None:
            write_batch(records, target.table("outbound"), batch_id)
        else:
            write_kafka(to_kafka_rows(records, target.codec, target.schema_id), target.kafka_options)

    def memory() -> None:
        if remember:
            target.memory(spark).add(batch_id, processed, oldest_us)

    together(lambda: write_batch(quarantine_rows(log), target.table("quarantine"), batch_id), customers, outbound, memory)


def merge_pending(
    spark: SparkSession, target: Target, batch_id: int, processed_at: datetime
) -> bool:
    """Bring the snapshot up to a batch from the outcome log; False if it is already there."""
    snapshot = target.snapshot(spark)
    log = read_range(spark, target.table("outcome_log"), S.OUTCOME, snapshot.current() + 1, batch_id)
    if log is None:
        return False
    pending = log.filter(F.col("outcome") == S.PROCESSED)
    return snapshot.merge(latest_per_customer(pending, processed_at), batch_id)


def quarantine_rows(log: DataFrame) -> DataFrame:
    """Records held back for a later replay, with the reason; the stream goes on without them."""
    return log.filter(needs_retry(F.col("outcome")))


def replay_rows(quarantine: DataFrame) -> DataFrame:
    """Quarantined records as envelopes again."""
    return quarantine.select(*S.ENVELOPE.names)


def write_outcomes(spark: SparkSession, target: Target, outcomes: DataFrame, batch_id: int) -> int | None:
    """Land a batch in the outcome log; the write counts the outcomes on its way, and they are kept for ``live_counts``.
    Returns the first arrival, in microseconds."""
    seen = Observation()
    counts = [F.count_if(F.col("outcome") == outcome).alias(outcome) for outcome in S.OUTCOMES]
    oldest = F.min(F.unix_micros("arrival_ts")).alias("oldest_us")
    write_batch(outcomes.observe(seen, oldest, *counts), target.table("outcome_log"), batch_id)
    found = seen.get
    oldest_us = found.pop("oldest_us")
    Manifests(spark, target.table("counters")).write(batch_id, {"batch_id": batch_id, **found})
    return oldest_us


def live_counts(spark: SparkSession, target: Target) -> DataFrame:
    """``batch_id, outcome, records`` of every batch that has landed; reads no record."""
    schema = ", ".join(f"{name} bigint" for name in ("batch_id", *S.OUTCOMES))
    counted = spark.read.schema(schema).json(target.table("counters"))
    return counted.unpivot("batch_id", list(S.OUTCOMES), "outcome", "records").filter("records > 0")


def run_batch(
    spark: SparkSession, envelopes: DataFrame, target: Target, batch_id: int, processed_at: datetime
) -> None:
    """Process one batch end to end; running the same batch again leaves the same tables."""
    with scratch_run(spark):
        seen = remembered_keys(spark, target, batch_id, envelopes)
        outcomes = build_outcomes(envelopes, target.ttl, seen, batch_id)
        oldest_us = write_outcomes(spark, target, outcomes, batch_id)
        write_sinks(spark, target, batch_id, processed_at, remember=True, oldest_us=oldest_us)
