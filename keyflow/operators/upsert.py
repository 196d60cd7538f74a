"""Latest state per customer and the merge into the customer snapshot."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow import schemas as S

# Newer state wins by the record's own place, then by delivery, so a late redelivery of an old record
# never overwrites a newer one.
_WRITE_ORDER = ["timestamp", "partition", "offset", "arrival_ts"]


def instant(processed_at: datetime | str | Column) -> Column:
    return processed_at if isinstance(processed_at, Column) else F.lit(processed_at).cast("timestamp")


def to_documents(accepted: DataFrame, processed_at: datetime | str | Column) -> DataFrame:
    """Map accepted events to customer documents; every field is replaced, nothing merged."""
    address = F.col("event.address")
    return accepted.select(
        F.col("event.customerId").alias("customerId"),
        F.col("event.phoneNumber").alias("phoneNumber"),
        F.struct(*[address[name].alias(name) for name in S.ADDRESS.names]).alias("address"),
        instant(processed_at).alias("updatedAt"),
        F.col("topic").alias("lastInboundTopic"),
        F.col("partition").alias("lastInboundPartition"),
        F.col("offset").alias("lastInboundOffset"),
        F.col("timestamp").alias("lastInboundTimestamp"),
        F.col("arrival_ts").alias("lastInboundArrival"),
    )


def _document_order(prefix: str = "") -> Column:
    names = [
        "lastInboundTimestamp",
        "lastInboundPartition",
        "lastInboundOffset",
        "lastInboundArrival",
    ]
    return F.struct(*[F.col(prefix + name) for name in names])


def latest_per_customer(accepted: DataFrame, processed_at: datetime | str | Column) -> DataFrame:
    """One document per customer: its last write.

    The maximum combines map-side, so a hot customer reaches the shuffle as one row per task.
    """
    order = F.struct(*_WRITE_ORDER)
    last = F.max_by(F.struct("topic", "partition", "offset", "timestamp", "arrival_ts", "event"), order)
    winners = accepted.groupBy(F.col("event.customerId").alias("_id")).agg(last.alias("_last"))
    return to_documents(winners.select("_last.*"), processed_at)


def merge_snapshot(snapshot: DataFrame, updates: DataFrame) -> DataFrame:
    """Next snapshot: updated customers replaced, the rest kept, older state never winning.

    Both sides have one row per customer, so the join has no hot keys. ``is_insert`` tells customers
    that had no document.
    """
    old = snapshot.select("customerId", F.struct(*S.CUSTOMER.names).alias("_old"))
    new = updates.select("customerId", F.struct(*S.CUSTOMER.names).alias("_new"))
    joined = old.join(new, "customerId", "full_outer")
    keeps = F.col("_new").isNull() | F.coalesce(
        _document_order("_old.") > _document_order("_new."), F.lit(False)
    )
    chosen = F.when(keeps, F.col("_old")).otherwise(F.col("_new"))
    return joined.select(chosen.alias("_doc"), F.col("_old").isNull().alias("is_insert")).select(
        "_doc.*", "is_insert"
    )


def lookup_documents(keys: DataFrame, snapshot: DataFrame) -> DataFrame:
    """Left lookup of stored documents for a table of distinct customer ids."""
    found = snapshot.select("customerId", F.struct(*S.CUSTOMER.names).alias("document"))
    return keys.join(found, "customerId", "left").withColumn("is_insert", F.col("document").isNull())


def merge_statement(target: str, source: str) -> str:
    """``MERGE INTO`` for tables whose format supports row-level changes."""
    stored = "struct(t.lastInboundTimestamp, t.lastInboundPartition, t.lastInboundOffset, t.lastInboundArrival)"
    sets = ", ".join(f"t.{name} = s.{name}" for name in S.CUSTOMER.names if name != "customerId")
    names = ", ".join(S.CUSTOMER.names)
    values = ", ".join(f"s.{name}" for name in S.CUSTOMER.names)
    return (
        f"MERGE INTO {target} t USING {source} s ON t.customerId = s.customerId "
        f"WHEN MATCHED AND {stored} <= {stored.replace('t.', 's.')} THEN UPDATE SET {sets} "
        f"WHEN NOT MATCHED THEN INSERT ({names}) VALUES ({values})"
    )
