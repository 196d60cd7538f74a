import os
import tempfile
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import SparkSession

from keyflow import schemas as S

START = datetime(2024, 1, 1, tzinfo=timezone.utc)
ADDRESS = ("1 Main", "Austin", "TX", "78701")


@pytest.fixture(scope="session")
def spark():
    os.environ.setdefault("TZ", "UTC")
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="keyflow-tests-"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


def day(number):
    return START + timedelta(days=number)


def header(name, value):
    return (name, None if value is None else value if isinstance(value, bytes) else value.encode())


def envelope(customer="cust-1", offset=0, arrival=0.0, phone="555-0100", address=ADDRESS, **over):
    """One delivery; ``arrival`` and ``at`` count in days, ``key`` is the idempotency header."""
    headers = over.get("headers", [])
    if over.get("key") is not None:
        headers = [*headers, header(S.IDEMPOTENCY_HEADER, over["key"])]
    event = None if over.get("null") else (customer, phone, address)
    return (
        over.get("topic", "inbound"),
        over.get("partition", 0),
        offset,
        day(over.get("at", arrival)),
        day(arrival),
        "record-key",
        headers,
        event,
    )


def log_of(spark, rows):
    return spark.createDataFrame(rows, S.ENVELOPE)


def outcomes_of(frame):
    """Outcomes in arrival order."""
    rows = frame.orderBy("arrival_ts", "partition", "offset", "topic").collect()
    return [row["outcome"] for row in rows]
