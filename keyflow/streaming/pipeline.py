"""The streaming pipeline: classify, dedup with keyed state, and write each micro-batch."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow import schemas as S
from keyflow.operators.classify import failed_rows, marked_outcome, valid_rows, with_dedup_key
from keyflow.plans.batch import Target, merge_pending, run_batch, write_outcomes, write_sinks
from keyflow.plans.outcomes import outcome_columns
from keyflow.session import scratch_run
from keyflow.sources.tables import read_if_present
from keyflow.streaming.dedup_state import stream_ttl_dedup, use_state_store


def stream_outcomes(envelopes: DataFrame, target: Target, always_on: bool = False) -> DataFrame:
    """The outcome of every streamed record; failed rows do not enter the state."""
    keyed = with_dedup_key(envelopes)
    marked = marked_outcome(stream_ttl_dedup(valid_rows(keyed), target.ttl, always_on))
    failed = failed_rows(keyed)
    return outcome_columns(marked, 0).unionByName(outcome_columns(failed, 0))


def _now(spark: SparkSession) -> datetime:
    return spark.range(1).select(F.current_timestamp()).first()[0]


def start_stream(
    spark: SparkSession,
    envelopes: DataFrame,
    target: Target,
    processed_at: datetime | str | None = None,
    always_on: bool = False,
    memory: str = "log",
    interval: str = "10 seconds",
) -> StreamingQuery:
    """Start the pipeline, for good or until what is there is done; each micro-batch lands in the outcome log first, then in the other sinks.

    ``memory`` says where accepted keys are remembered. ``log`` runs each micro-batch as a batch that reads
    the accepted keys of the last TTL back from the outcome log: all built-in expressions and safe for
    any hot key. ``state`` is the keyed state store: its work depends on the micro-batch alone, but
    its handler is Python, and the intake limit bounds a hot key.

    A repeated micro-batch overwrites its own folders, so restarts write nothing twice. Without
    ``processed_at`` the time is taken once per micro-batch.
    """
    if memory not in ("state", "log"):
        raise ValueError("memory must be state or log")

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        when = processed_at or _now(session)
        if memory == "log":
            run_batch(session, batch, target, batch_id, when)
        else:
            write_outcomes(session, target, batch, batch_id)
            with scratch_run(session):
                write_sinks(session, target, batch_id, when)

    rows = envelopes
    if memory == "state":
        use_state_store(spark)
        rows = stream_outcomes(envelopes, target, always_on)
    writer = (
        rows.writeStream.outputMode("append")
        .option("checkpointLocation", target.table("checkpoint"))
        .foreachBatch(write)
    )
    if always_on:
        return writer.trigger(processingTime=interval).start()
    return writer.trigger(availableNow=True).start()


def run_stream(
    spark: SparkSession,
    envelopes: DataFrame,
    target: Target,
    processed_at: datetime | str | None = None,
    memory: str = "log",
    timeout: int | None = None,
) -> None:
    """Drain what has landed so far, bring the snapshot up to date, and stop."""
    query = start_stream(spark, envelopes, target, processed_at, memory=memory)
    try:
        if query.awaitTermination(timeout) is False:
            raise TimeoutError("the stream did not drain in time")
    finally:
        query.stop()
    log = read_if_present(spark, target.table("outcome_log"), S.OUTCOME)
    if target.merge_every > 1 and log is not None:
        newest = log.agg(F.max("batch_id")).first()[0]
        merge_pending(spark, target, newest, processed_at or _now(spark))
