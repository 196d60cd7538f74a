"""Reports over the outcome log: poll batches, committable prefixes, counts, hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.classify import needs_retry
from keyflow.operators.numbering import offset_numbers

_BATCH = ["topic", "partition", "poll"]


def first_deliveries(log: DataFrame) -> DataFrame:
    """The first delivery of every offset, with its outcome; combined map-side."""
    order = F.struct(F.col("arrival_ts"), F.col("outcome") != S.PROCESSED)
    first = F.min_by(F.struct("outcome", "arrival_ts"), order)
    grouped = log.groupBy("topic", "partition", "offset").agg(first.alias("_first"))
    return grouped.select("topic", "partition", "offset", "_first.outcome", "_first.arrival_ts")


def poll_batches(log: DataFrame, size: int = S.POLL_SIZE) -> DataFrame:
    """Cut each partition's log into polls of ``size`` records: ``poll`` and ``idx``, both from 0."""
    numbered = offset_numbers(log, "_number")
    return numbered.withColumns(
        {
            "poll": ((F.col("_number") - F.pmod("_number", F.lit(size))) / size).cast("bigint"),
            "idx": F.pmod("_number", F.lit(size)).cast("int"),
        }
    ).drop("_number")


def first_retryable(polls: DataFrame) -> DataFrame:
    """Size of every poll and the index of its first record to retry, null if all are done."""
    retry_idx = F.when(needs_retry(F.col("outcome")), F.col("idx"))
    return polls.groupBy(*_BATCH).agg(
        F.count(F.lit(1)).alias("size"), F.min(retry_idx).alias("first_retry")
    )


def commit_state(polls: DataFrame) -> DataFrame:
    """Add ``committed`` (before the first record to retry) and ``redelivered`` (done, yet after it).

    A poll holds a fixed small number of records, so the window is bounded.
    """
    retry = needs_retry(F.col("outcome"))
    upto = Window.partitionBy(*_BATCH).orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    committed = F.sum(retry.cast("int")).over(upto) == 0
    return polls.withColumn("committed", committed).withColumn(
        "redelivered", ~F.col("committed") & ~retry
    )


def outcome_counts(log: DataFrame) -> DataFrame:
    return log.groupBy("topic", "partition", "outcome").agg(F.count(F.lit(1)).alias("records"))


def hot_customers(log: DataFrame, window: str = S.LOCK_WINDOW) -> DataFrame:
    """Customers with more than one record in a window: those that would queue for one lock."""
    slot = F.window("arrival_ts", window).alias("_window")
    counts = log.groupBy(F.col("event.customerId").alias("customerId"), slot).agg(F.count(F.lit(1)).alias("records"))
    return counts.filter("records > 1").select("customerId", F.col("_window.start").alias("window_start"), "records")
