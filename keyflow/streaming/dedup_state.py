"""TTL dedup as keyed state: the streaming form of ``operators.dedup.ttl_dedup``.

The store is asked from Python, one call at a time, so its unit is not the key: 1,000 neighbouring offsets of a partition share one
state, which is read and written once for all rows that a micro-batch has of them. Keys from headers have no neighbours; they keep a
state each and are dealt into groups by their hash, so that a call of the handler serves many of them.
"""

from __future__ import annotations

import json
import sys
from collections.abc import Iterator

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from keyflow import schemas as S
from keyflow.operators.dedup import ttl_micros

#: Places of the offset keys of a unit: JSON of the last digits of each key and its ``us, partition, offset, topic``.
BLOCK = S.struct(places="string")
KEY = S.struct(dedup_key="string")
STATE = S.struct(last_us="bigint", partition="int", offset="bigint", topic="string")
STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: Last digits of an offset that a unit leaves out, so it has at most 1,110 keys.
BLOCK_DIGITS = 3
#: Groups of the keys from headers.
HASHED = 1024

# The processor travels by value, so executors need no copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


NARROW = S.struct(unit="string", dedup_key="string", us="bigint", partition="int", offset="bigint", topic="string", payload="string")
MARKED = T.StructType([*NARROW.fields[1:], *S.struct(accepted="boolean", dedup_reason="string").fields])


def unit_of(key: Column) -> Column:
    """The unit of state of a key, which depends on the key alone: equal keys always meet."""
    neighbours = F.regexp_replace(key, f"[0-9]{{1,{BLOCK_DIGITS}}}$", "")
    hashed = F.concat(F.lit("hash:"), F.pmod(F.xxhash64(key), F.lit(HASHED)).cast("string"))
    return F.when(key.startswith(S.OFFSET_KEY_PREFIX), neighbours).otherwise(hashed)


class TtlDedup(StatefulProcessor):
    """Remembers the last accepted delivery of a key and marks every row against it.

    Rows of a unit come unordered within a micro-batch, so they are sorted here; the source's intake
    limit bounds how many there can be. With cleanup, a unit of offsets, or a key from a header, is forgotten by the clock after two
    TTLs without an accepted row; a stream that lags by more than one TTL may then accept a duplicate.
    """

    def __init__(self, ttl_us: int, cleanup: bool, prefix: str = S.OFFSET_KEY_PREFIX):
        self._ttl_us = ttl_us
        self._cleanup = cleanup
        self._prefix = prefix
        self._schemas = BLOCK, KEY, STATE
        self._names = MARKED.names

    def init(self, handle: StatefulProcessorHandle) -> None:
        # Expiry follows arrival times; the store's own clock only clears keys long out of use.
        cleanup_ms = 2 * self._ttl_us // 1000 if self._cleanup else None
        block, key, last = self._schemas
        self._block = handle.getValueState("block", block, ttlDurationMs=cleanup_ms)
        self._hashed = handle.getMapState("hashed", key, last, ttlDurationMs=cleanup_ms)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        table = pd.concat(list(rows), ignore_index=True)
        keys, us, partition, offset, topic = (table[name].tolist() for name in ("dedup_key", "us", "partition", "offset", "topic"))
        unit = key[0]
        if unit.startswith(self._prefix):
            stored = self._block.get()
            last = {} if stored is None else {unit + digits: tuple(place) for digits, place in json.loads(stored[0]).items()}
        else:
            found = ((name, self._hashed.getValue((name,))) for name in set(keys))
            last = {name: tuple(place) for name, place in found if place is not None}
        accepted, reasons, changed = [False] * len(keys), [None] * len(keys), set()
        for place, at in sorted((place, at) for at, place in enumerate(zip(us, partition, offset, topic, strict=True))):
            name = keys[at]
            before = last.get(name)
            if before is None or place[0] - before[0] >= self._ttl_us:
                accepted[at] = True
                last[name] = place
                changed.add(name)
            else:
                reasons[at] = "offset" if before[1:] == place[1:] else "idempotency-key"
        if changed and unit.startswith(self._prefix):
            self._block.update((json.dumps({name[len(unit) :]: place for name, place in last.items()}),))
        elif changed:
            for name in changed:
                self._hashed.updateValue((name,), last[name])
        table["accepted"], table["dedup_reason"] = accepted, pd.Series(reasons, dtype=object)
        yield table[self._names]

    def close(self) -> None:
        pass


def stream_ttl_dedup(rows: DataFrame, ttl: str = S.DEDUP_TTL, always_on: bool = False) -> DataFrame:
    """Mark a stream of keyed rows; no watermark, an old record is compared like any other.

    ``always_on`` adds processing-time cleanup of old state. Replays leave it off: a store that
    watches the clock keeps a finite run from ending.
    """
    carried = [name for name in rows.columns if name not in ("dedup_key", "partition", "offset", "topic")]
    payload = rows.select(*carried).schema
    times = [field.name for field in payload if isinstance(field.dataType, T.TimestampType)]
    exact = [F.unix_micros(name).alias(name) if name in times else F.col(name) for name in carried]
    packed = T.StructType([T.StructField(f.name, T.LongType() if f.name in times else f.dataType) for f in payload])
    own = [F.col(name) for name in rows.columns if name not in carried]
    narrow = rows.select(
        *own, unit_of(F.col("dedup_key")).alias("unit"), F.unix_micros("arrival_ts").alias("us"), F.to_json(F.struct(*exact)).alias("payload")
    )
    marked = narrow.select(*NARROW.names).groupBy("unit").transformWithStateInPandas(
        statefulProcessor=TtlDedup(ttl_micros(ttl), always_on),
        outputStructType=MARKED,
        outputMode="Append",
        timeMode="ProcessingTime" if always_on else "None",
    )
    unpacked = marked.withColumn("payload", F.from_json("payload", packed))
    values = [(F.timestamp_micros(f"payload.{name}") if name in times else F.col(f"payload.{name}")).alias(name) for name in carried]
    return unpacked.select(*own, *values, "accepted", "dedup_reason").select(*rows.columns, "accepted", "dedup_reason")


def stream_first_wins(rows: DataFrame, delay: str = S.DEDUP_TTL) -> DataFrame:
    """First delivery of every key within a watermark: built in, but drops skips and late rows."""
    return rows.withWatermark("arrival_ts", delay).dropDuplicatesWithinWatermark(["dedup_key"])


def use_state_store(spark: SparkSession) -> None:
    """Store settings; batches without data are off, as a store with cleanup asks for them forever."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
