"""Live views with built-in streaming aggregation: changed customer documents, and hot customers.

State is one row per customer, or per customer and open window; only rows that a micro-batch changes come out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from keyflow import schemas as S
from keyflow.operators.reports import hot_customers
from keyflow.operators.upsert import latest_per_customer
from keyflow.sources.tables import SnapshotTable, write_batch
from keyflow.streaming.dedup_state import use_state_store


def stream_outcome_log(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The outcome log as a stream of its files."""
    reader = spark.readStream.schema(S.OUTCOME)
    return (reader if max_files is None else reader.option("maxFilesPerTrigger", max_files)).parquet(path)


def changed_documents(outcomes: DataFrame, processed_at: str) -> DataFrame:
    """The last document of every customer; in update mode those that changed. A late redelivery changes nothing."""
    return latest_per_customer(outcomes.filter(F.col("outcome") == S.PROCESSED), processed_at)


def start_documents(outcomes: DataFrame, snapshot: SnapshotTable, checkpoint: str, processed_at: str, before: int = 0) -> StreamingQuery:
    """Keep a snapshot up to date from the outcome log: each micro-batch merges its changed documents only.

    ``before`` is the snapshot's version when the stream first began; micro-batch n becomes version ``before + 1 + n``, and a
    repeated one changes nothing.
    """
    use_state_store(snapshot.spark)

    def merge(batch: DataFrame, batch_id: int) -> None:
        table = SnapshotTable(batch.sparkSession, snapshot.path, snapshot.keep, snapshot.buckets)
        table.merge(batch, before + 1 + batch_id)

    writer = changed_documents(outcomes, processed_at).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(merge).trigger(availableNow=True).start()


def start_hot_customers(records: DataFrame, path: str, checkpoint: str, window: str = S.LOCK_WINDOW, delay: str = "1 hour") -> StreamingQuery:
    """Counts of customers with several records in a window of arrival time, as they grow.

    A window closes ``delay`` after its end in arrival time, in the micro-batch after the one that moved the watermark so far.
    Records that come later are left out and counted apart (``late_records``). Each micro-batch writes the counts it
    changed below ``path``.
    """
    use_state_store(records.sparkSession)
    counts = hot_customers(records.withWatermark("arrival_ts", delay), window)
    writer = counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
    return writer.foreachBatch(lambda batch, batch_id: write_batch(batch, path, batch_id)).trigger(availableNow=True).start()


def hot_so_far(spark: SparkSession, path: str) -> DataFrame:
    """The counts of all micro-batches: the last of a customer and window is the largest."""
    schema = "customerId string, window_start timestamp, records bigint, batch_id bigint"
    counts = spark.read.schema(schema).option("basePath", path).parquet(path)
    return counts.groupBy("customerId", "window_start").agg(F.max("records").alias("records"))


def late_records(query: StreamingQuery) -> int:
    """Records that came after their window had closed, in the progress that the query still holds.

    A micro-batch counts one for all late records of a customer and window that one of its tasks had."""
    return sum(state["numRowsDroppedByWatermark"] for progress in query.recentProgress for state in progress["stateOperators"])
