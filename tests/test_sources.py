import json
from datetime import datetime, timezone

import pytest
from conftest import ADDRESS, envelope, log_of
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.sources import codecs, envelopes, tables

EVENT_JSON = json.dumps({"customerId": "c", "phoneNumber": "p", "address": dict(zip(S.ADDRESS.names, ADDRESS))})


def test_kafka_options():
    read = envelopes.kafka_read_options("host:1", group="g", max_offsets=500, failOnDataLoss="false")
    assert read == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "customer.ingest.in",
        "startingOffsets": "earliest",
        "kafka.isolation.level": "read_committed",
        "includeHeaders": "true",
        "maxOffsetsPerTrigger": "500",
        "kafka.group.id": "g",
        "failOnDataLoss": "false",
    }
    assert envelopes.kafka_write_options("host:1")["kafka.acks"] == "all"


@pytest.mark.parametrize(
    "value, customer",
    [
        (EVENT_JSON.encode(), "c"),
        (b'{"customerId": "cut', None),
        (b"not json", None),
        (b"", None),
        (None, None),
        (b"\xff\xfe", None),
    ],
)
def test_bad_payload_decodes_to_null(spark, value, customer):
    frame = spark.createDataFrame([(value,)], "value binary")
    event = frame.select(codecs.decode(F.col("value")).alias("event")).first().event
    assert (None if event is None else event.customerId) == customer


def test_payload_without_fields_is_an_event(spark):
    frame = spark.createDataFrame([(b"{}",)], "value binary")
    event = frame.select(codecs.decode(F.col("value")).alias("event")).first().event
    assert event is not None and event.customerId is None


def test_kafka_columns_become_an_envelope(spark):
    raw = "topic string, partition int, offset bigint, timestamp timestamp, key binary, value binary, "
    raw += "headers array<struct<key: string, value: binary>>"
    source = log_of(spark, [envelope()]).first()
    record = ("t", 1, 2, source.timestamp, b"k", EVENT_JSON.encode(), None)
    rows = envelopes.from_kafka_columns(spark.createDataFrame([record], raw))
    assert rows.schema.simpleString() == S.ENVELOPE.simpleString()
    row = rows.first()
    assert (row.topic, row.key, row.arrival_ts) == ("t", "k", row.timestamp)
    assert tuple(row.event.address) == ADDRESS


def test_outbound_rows_for_kafka(spark):
    event = F.struct(F.lit("c").alias("customerId"))
    records = spark.range(1).select(
        F.lit("out").alias("topic"),
        F.lit("c").alias("key"),
        event.alias("event"),
        F.array().cast(S.HEADERS).alias("headers"),
    )
    row = tables.to_kafka_rows(records).first()
    assert (bytes(row.key), json.loads(bytes(row.value))) == (b"c", {"customerId": "c"})


def test_avro_schemas_and_wire_prefix():
    inbound, outbound = json.loads(codecs.INBOUND_AVRO), json.loads(codecs.OUTBOUND_AVRO)
    assert [f["name"] for f in inbound["fields"]] == S.EVENT.names
    assert [f["name"] for f in inbound["fields"][2]["type"]["fields"]] == S.ADDRESS.names
    types = {f["name"]: f["type"] for f in outbound["fields"]}
    assert types["status"]["symbols"] == ["PROCESSED", "SKIPPED_DUPLICATE", "FAILED"]
    assert (types["inboundPartition"], types["inboundOffset"]) == ("int", "long")
    assert codecs.wire_prefix(258) == b"\x00\x00\x00\x01\x02"


def test_avro_needs_a_schema_id():
    with pytest.raises(ValueError):
        codecs.encode(None, "avro")


def test_arrival_defaults_to_the_time_of_the_record(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = log_of(spark, [envelope(at=1, arrival=2)])
    rows.withColumn("arrival_ts", F.lit(None).cast("timestamp")).write.parquet(path)
    row = envelopes.read_log(spark, path).first()
    assert row.arrival_ts == row.timestamp


def test_filters_and_columns_reach_the_log_files(spark, tmp_path):
    path = str(tmp_path / "log")
    log_of(spark, [envelope()]).write.parquet(path)
    rows = envelopes.read_log(spark, path).filter(F.col("partition") > 5).select("offset")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(partition" in plan
    assert "ReadSchema: struct<partition:int,offset:bigint>" in plan


def test_streams_are_bounded(spark, tmp_path):
    for bound in ({"max_bytes": None}, {"max_bytes": 0}, {"max_files": 0}):
        with pytest.raises(ValueError):
            envelopes.stream_log(spark, str(tmp_path), **bound)


def test_a_topic_as_a_batch_needs_its_end():
    options = envelopes.kafka_read_options("broker:9092", group="g")
    for end in ({}, {"endingOffsets": "latest"}):
        with pytest.raises(ValueError):
            envelopes.batch_options({**options, **end})
    end = '{"customer.ingest.in":{"0":5}}'
    bounded = envelopes.batch_options({**options, "endingOffsets": end})
    assert bounded["endingOffsets"] == end
    assert "maxOffsetsPerTrigger" not in bounded and "kafka.group.id" not in bounded


def test_a_body_that_cannot_be_read_is_a_null_event(spark):
    address = "struct<street: string, city: string, state: string, zip: string>"
    rows = spark.createDataFrame(
        [((None, None, None),), (("a", None, None),)], f"e struct<customerId: string, phoneNumber: string, address: {address}>"
    )
    got = rows.select(codecs.complete(F.col("e")).alias("e")).collect()
    assert got[0].e is None and got[1].e.customerId == "a"


def test_raw_log_is_decoded(spark, tmp_path):
    path = str(tmp_path / "raw")
    body = b'{"customerId":"a","phoneNumber":"1","address":{"street":"s","city":"c","state":"TX","zip":"z"}}'
    at = datetime(2024, 1, 2, tzinfo=timezone.utc)
    rows = [("t", 0, n, at, None, b"k", [], value) for n, value in enumerate([body, b"{", None])]
    spark.createDataFrame(rows, S.RAW_ENVELOPE).write.parquet(path)
    got = {r.offset: r for r in envelopes.read_raw_log(spark, path).collect()}
    assert got[0].event.customerId == "a" and got[1].event is None and got[2].event is None
    assert all(r.arrival_ts == r.timestamp and r.key == "k" for r in got.values())
