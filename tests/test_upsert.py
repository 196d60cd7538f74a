from conftest import ADDRESS, day, envelope, log_of

from keyflow import schemas as S
from keyflow.operators import upsert

AT = "2024-02-15 00:00:00"


def document(customer, offset=None, at=None, phone="old"):
    when = None if at is None else day(at)
    return (customer, phone, ADDRESS, day(0), "inbound", 0, offset, when, when)


def snapshot_of(spark, rows):
    return spark.createDataFrame(rows, S.CUSTOMER)


def by_id(frame):
    return {row.customerId: row for row in frame.collect()}


def test_document_mapping(spark):
    row = upsert.to_documents(log_of(spark, [envelope("c", 21, partition=3)]), AT).first()
    assert (row.customerId, row.phoneNumber, tuple(row.address)) == ("c", "555-0100", ADDRESS)
    assert (row.lastInboundTopic, row.lastInboundPartition, row.lastInboundOffset) == ("inbound", 3, 21)
    assert row.updatedAt.isoformat() == "2024-02-15T00:00:00"


def test_one_row_per_customer_after_a_skewed_batch(spark):
    rows = [envelope("same", n, n / 100, phone=f"p{n}") for n in range(200)]
    rows += [envelope(f"c{n}", 1000 + n) for n in range(20)]
    log = log_of(spark, rows).repartition(8)
    got = by_id(upsert.latest_per_customer(log, AT))
    assert len(got) == 21
    assert got["same"].phoneNumber == "p199"


def test_order_is_record_time_then_partition_then_offset(spark):
    rows = [
        envelope("c", 5, arrival=9, at=0, phone="late delivery of an old record"),
        envelope("c", 7, arrival=1, at=1, phone="partition 0"),
        envelope("c", 2, arrival=1, at=1, partition=1, phone="same time, partition 1"),
        envelope("c", 1, arrival=1, at=1, partition=1, phone="same time and partition, earlier"),
    ]
    assert by_id(upsert.latest_per_customer(log_of(spark, rows), AT))["c"].phoneNumber == "same time, partition 1"


def test_merge_replaces_keeps_and_inserts(spark):
    old = snapshot_of(spark, [document("keep", 1, 0), document("change", 1, 0), document("imported")])
    new = snapshot_of(
        spark,
        [document("change", 2, 1, "new"), document("imported", 3, 1, "new"), document("add", 4, 1, "new")],
    )
    got = by_id(upsert.merge_snapshot(old, new))
    assert {k: (v.phoneNumber, v.is_insert) for k, v in got.items()} == {
        "keep": ("old", False),
        "change": ("new", False),
        "imported": ("new", False),
        "add": ("new", True),
    }


def test_older_update_does_not_overwrite(spark):
    old = snapshot_of(spark, [document("c", 9, 5)])
    new = snapshot_of(spark, [document("c", 2, 1, "stale")])
    assert by_id(upsert.merge_snapshot(old, new))["c"].phoneNumber == "old"


def test_lookup_tells_inserts(spark):
    keys = spark.createDataFrame([("a",), ("b",)], "customerId string")
    found = by_id(upsert.lookup_documents(keys, snapshot_of(spark, [document("a", 1, 0)])))
    assert found["a"].is_insert is False and found["a"].document.phoneNumber == "old"
    assert found["b"].is_insert is True and found["b"].document is None


def test_merge_statement_compares_before_updating():
    sql = upsert.merge_statement("lake.customers", "updates")
    assert sql.startswith("MERGE INTO lake.customers t USING updates s ON t.customerId = s.customerId")
    assert "WHEN MATCHED AND struct(t.lastInboundTimestamp" in sql
    assert "t.customerId = s.customerId," not in sql
    assert sql.endswith("s.lastInboundTimestamp, s.lastInboundArrival)")
