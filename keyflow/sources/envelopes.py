"""Inbound logs: message topics and landed files, as batch or stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.sources.codecs import decode

# Intake of one micro-batch over all partitions. It also bounds what one key can bring in one batch.
MAX_OFFSETS_PER_TRIGGER = 200_000
MAX_BYTES_PER_TRIGGER = 128 * 1024 * 1024


def kafka_read_options(
    servers: str,
    topic: str = S.INBOUND_TOPIC,
    group: str | None = None,
    max_offsets: int = MAX_OFFSETS_PER_TRIGGER,
    **extra: str,
) -> dict[str, str]:
    """Committed records only, from the earliest offset, with headers and a bounded intake."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": str(max_offsets),
    }
    if group:
        options["kafka.group.id"] = group
    return {**options, **extra}


def kafka_write_options(servers: str, **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "kafka.acks": "all", **extra}


def from_kafka_columns(records: DataFrame, codec: str = "json", arrival: Column | None = None) -> DataFrame:
    """Kafka source columns to envelopes; ``arrival`` defaults to the record's own time."""
    return records.select(
        "topic",
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        "timestamp",
        (F.col("timestamp") if arrival is None else arrival).alias("arrival_ts"),
        F.col("key").cast("string").alias("key"),
        F.col("headers").cast(S.HEADERS).alias("headers"),
        decode(F.col("value"), codec).alias("event"),
    )


def batch_options(options: dict[str, str]) -> dict[str, str]:
    """Read options of a batch. Its end must be given as offsets: a plan reads the topic more than once, and an
    open end could be another one each time."""
    if options.get("endingOffsets", "latest") == "latest":
        raise ValueError("a batch needs endingOffsets that name offsets")
    return {k: v for k, v in options.items() if k not in ("maxOffsetsPerTrigger", "kafka.group.id")}


def read_kafka(spark: SparkSession, options: dict[str, str], codec: str = "json") -> DataFrame:
    """A topic as a batch; needs the Kafka package."""
    return from_kafka_columns(spark.read.format("kafka").options(**batch_options(options)).load(), codec)


def stream_kafka(spark: SparkSession, options: dict[str, str], codec: str = "json") -> DataFrame:
    """A topic as a stream; arrival is the time of ingest."""
    records = spark.readStream.format("kafka").options(**options).load()
    return from_kafka_columns(records, codec, F.current_timestamp())


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """A landed envelope log as a batch; filters on its columns reach the files."""
    return _arrived(spark.read.schema(S.ENVELOPE).parquet(path))


def stream_log(
    spark: SparkSession, path: str, max_bytes: int = MAX_BYTES_PER_TRIGGER, max_files: int | None = None
) -> DataFrame:
    """A landed envelope log as a stream, oldest files first; files must land in arrival order.

    ``max_bytes``, or ``max_files`` if given, bounds a micro-batch; there is no stream without a bound.
    """
    if max_bytes is None or max_bytes <= 0 or (max_files is not None and max_files <= 0):
        raise ValueError("a stream needs a bounded intake")
    bound = ("maxBytesPerTrigger", max_bytes) if max_files is None else ("maxFilesPerTrigger", max_files)
    return _arrived(spark.readStream.schema(S.ENVELOPE).option(bound[0], str(bound[1])).parquet(path))


def read_raw_log(spark: SparkSession, path: str, codec: str = "json") -> DataFrame:
    """A landed log of undecoded records."""
    raw = spark.read.schema(S.RAW_ENVELOPE).parquet(path)
    return from_kafka_columns(raw, codec, F.coalesce("arrival_ts", "timestamp"))


def _arrived(log: DataFrame) -> DataFrame:
    """A record that landed without arrival time arrived at its own time."""
    return log.withColumn("arrival_ts", F.coalesce("arrival_ts", "timestamp"))
