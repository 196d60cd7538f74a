"""Batch deduplication with a time-to-live.

A delivery is accepted when its key was never accepted before, or when at least the TTL has passed
since the last accepted delivery of the key. Skipped deliveries do not extend the TTL, so this is a
sequential rule per key; gaps between neighbours do not decide it.

Rows here have ``topic, partition, offset, arrival_ts, dedup_key`` and any payload columns.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.numbering import staged_numbers
from keyflow.operators.skew import HEAVY_FLOOR, SALTS, frequent_keys, split_heavy
from keyflow.session import scratch_path

KEY = "dedup_key"
PLACE = ["us", "partition", "offset", "topic"]
PLACE_TYPE = "struct<us: bigint, partition: int, offset: bigint, topic: string>"
# Marks of the fold.
ACCEPTED, SAME_PLACE, OTHER_PLACE = 1, 2, 3
# Rounds of doubling between two cuts of lineage.
CUT = 3
# Accepted places of heavy keys that may be broadcast; more meet their rows salted.
MAX_BROADCAST_MARKS = 200_000


def ttl_micros(ttl: str) -> int:
    """Length of an interval text such as ``7 days`` in microseconds."""
    units = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}
    number, unit = ttl.split()
    micros = int(number) * units[unit.rstrip("s")] * 1_000_000
    if micros <= 0:
        raise ValueError("the dedup TTL must be positive")
    return micros


def delivery_place() -> Column:
    """Where and when a delivery came in; its order is the processing order."""
    return F.struct(
        F.unix_micros("arrival_ts").alias("us"),
        F.col("partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        F.col("topic").alias("topic"),
    )


def dedup_reason(place: Column, last: Column) -> Column:
    """Which key found the duplicate: the offset if the last accepted row is a copy of this one."""
    same = (
        (place["topic"] == last["topic"])
        & (place["partition"] == last["partition"])
        & (place["offset"] == last["offset"])
    )
    return F.when(same, F.lit("offset")).otherwise(F.lit("idempotency-key"))


def seen_keys(accepted: DataFrame) -> DataFrame:
    """The last accepted delivery of every key, as the memory for a later run."""
    last = F.max(delivery_place()).alias("last")
    return accepted.groupBy(KEY).agg(last).select(
        KEY,
        F.timestamp_micros(F.col("last.us")).alias("arrival_ts"),
        "last.partition",
        "last.offset",
        "last.topic",
    )


def ttl_dedup(rows: DataFrame, ttl: str = S.DEDUP_TTL, seen: DataFrame | None = None, floor: int = HEAVY_FLOOR) -> DataFrame:
    """Mark every row with ``accepted`` and, for duplicates, ``dedup_reason``.

    ``seen`` holds keys accepted by earlier runs (see ``seen_keys``). Rows meet their key in one shuffle, and memory per key is
    constant however many rows it has. Keys with more than ``floor`` rows never come into one task: their accepted
    places are found by pointer doubling.
    """
    micros = ttl_micros(ttl)
    seeds = None if seen is None else seen.groupBy(KEY).agg(F.max(delivery_place()).alias("_seed"))
    heavy = frequent_keys(rows, KEY, floor)
    if heavy is None:
        return _settle_keys(rows, micros, seeds)
    hot, rest = split_heavy(rows, heavy, KEY)
    both = _settle_keys(rest, micros, seeds).unionByName(_jump_keys(hot, heavy, micros, seeds))
    return both.select(*rows.columns, "accepted", "dedup_reason")


def _settle_keys(rows: DataFrame, micros: int, seeds: DataFrame | None) -> DataFrame:
    """Dedup in one pass over rows sorted by key and place.

    The first and the last place of a key settle it if they are less than one TTL apart: either its first row is accepted and no
    other, or the remembered row forbids all. Only keys with a longer span go through a fold, which keeps one place.
    """
    order = Window.partitionBy(KEY).orderBy("_place")
    whole = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    if seeds is None:
        seeded = rows.withColumn("_seed", F.lit(None).cast(PLACE_TYPE))
    else:
        seeded = rows.join(seeds, KEY, "left")
    placed = seeded.withColumn("_place", delivery_place()).withColumns(
        {"_number": F.row_number().over(order), "_first": F.first("_place").over(whole), "_last_us": F.last("_place").over(whole)["us"]}
    )
    since = F.col("_seed.us")
    forbidden = F.coalesce(F.col("_last_us") - since < micros, F.lit(False))
    fresh = F.coalesce(F.col("_first.us") - since >= micros, F.lit(True)) & (F.col("_last_us") - F.col("_first.us") < micros)
    settled = placed.withColumns({"_fresh": fresh, "_open": ~(forbidden | fresh)})
    narrow = [F.col(KEY), *(F.col("_place")[name] for name in PLACE), *(F.col("_seed")[name] for name in PLACE)]
    mark = _fold(micros)(*(F.when(F.col("_open"), column) for column in narrow))
    marked = settled.withColumn("_mark", mark)
    last = F.when(F.col("_fresh"), F.col("_first")).otherwise(F.col("_seed"))
    accepted = F.when(F.col("_open"), F.col("_mark") == ACCEPTED).otherwise(F.col("_fresh") & (F.col("_number") == 1))
    folded = F.when(F.col("_mark") == SAME_PLACE, F.lit("offset")).otherwise(F.lit("idempotency-key"))
    reason = F.when(F.col("_open"), folded).otherwise(dedup_reason(F.col("_place"), last))
    found = marked.withColumn("accepted", accepted).withColumn("dedup_reason", F.when(~F.col("accepted"), reason))
    return found.select(*rows.columns, "accepted", "dedup_reason")


def _fold(micros: int):
    """A function that marks rows sorted by key and place: accepted, a duplicate of its own place, or of another.

    It carries the last accepted place from batch to batch and jumps from one accepted row to the next. It is
    declared not deterministic so that no filter moves below it; rows with a null key are not looked at.
    """

    def marks(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        key, last = None, None
        for columns in batches:
            keys, topics, seed_topics = columns[0], columns[4], columns[8]
            us, partitions, offsets = (columns[at].fill_null(0).to_numpy() for at in (1, 2, 3))
            out = np.zeros(len(keys), np.int8)
            none = keys.is_null().to_numpy(zero_copy_only=False)
            same_key = pc.fill_null(pc.equal(keys[1:], keys[:-1]), False).to_numpy(zero_copy_only=False) | (none[1:] & none[:-1])
            starts = [0, *(np.flatnonzero(~same_key) + 1).tolist()] if len(keys) else []
            for begin, end in zip(starts, [*starts[1:], len(keys)], strict=True):
                if none[begin]:
                    continue
                if keys[begin].as_py() != key:
                    key, last = keys[begin].as_py(), None
                    if columns[5][begin].is_valid:
                        last = columns[5][begin].as_py(), columns[6][begin].as_py(), columns[7][begin].as_py(), seed_topics[begin].as_py()
                at = begin
                while at < end:
                    upto = end if last is None else begin + int(np.searchsorted(us[begin:end], last[0] + micros))
                    if last is not None and upto > at:
                        same = (partitions[at:upto] == last[1]) & (offsets[at:upto] == last[2])
                        same &= pc.equal(topics[at:upto], last[3]).to_numpy(zero_copy_only=False)
                        out[at:upto] = np.where(same, SAME_PLACE, OTHER_PLACE)
                        at = upto
                    if at < end:
                        out[at] = ACCEPTED
                        last = int(us[at]), int(partitions[at]), int(offsets[at]), topics[at].as_py()
                        at += 1
            yield pa.array(out)

    return F.arrow_udf(marks, "tinyint").asNondeterministic()


def _mark(rows: DataFrame, first_copy: Column, last: Column) -> DataFrame:
    """Accepted is the first copy at an accepted place; all others are duplicates of ``last``."""
    accepted = F.coalesce((F.col("_cur") == F.col("_place")) & first_copy, F.lit(False))
    reason = F.when(~accepted, dedup_reason(F.col("_place"), last))
    return rows.withColumns({"accepted": accepted, "dedup_reason": reason})


def _jump_keys(rows: DataFrame, heavy: DataFrame, micros: int, seeds: DataFrame | None) -> DataFrame:
    """Dedup of heavy keys, with no hot row in one task.

    The rows are written once. Their distinct instants (a minimum that combines map-side) are numbered by a range sort; a
    second one of instants and instants a TTL later tells each instant the number of the first one it allows. Doubling those
    jumps reaches all accepted instants in as many rounds as the logarithm of span over TTL. Marking the rows is one
    join on key and TTL block with the at most two accepted places that matter there, broadcast or salted.
    """
    spark = rows.sparkSession
    keys = heavy.select(KEY, F.lit(None).cast(PLACE_TYPE).alias("_seed"))
    if seeds is not None:
        keys = heavy.join(seeds.join(F.broadcast(heavy), KEY, "left_semi"), KEY, "left")
    us = F.unix_micros("arrival_ts")
    block = ((us - F.pmod(us, F.lit(micros))) / F.lit(micros)).cast("bigint")
    staged_columns = {"_block": block, "_place": delivery_place(), "_copy": F.monotonically_increasing_id()}
    staged = _staged(rows.join(F.broadcast(keys), KEY).withColumns(staged_columns), "hot")
    free = staged.filter(F.col("_seed").isNull() | (F.col("_place.us") - F.col("_seed.us") >= micros))
    first = F.min(F.struct(F.col("_place").alias("place"), F.col("_copy").alias("copy"))).alias("first")
    instants = staged_numbers(free.groupBy(KEY, F.col("_place.us").alias("us")).agg(first), KEY, ["us"], "number")
    number = F.lit(None).cast("bigint")
    asked = instants.select(KEY, (F.col("us") + micros).alias("us"), F.lit(0).alias("kind"), "number")
    given = instants.select(KEY, "us", F.lit(1).alias("kind"), number.alias("number"))
    # of what comes before a question, as many are questions as its own number says; the rest are instants
    asking = staged_numbers(asked.unionByName(given), KEY, ["us", "kind"], "position").filter("kind = 0")
    jumps = asking.select(KEY, "number", (F.col("position") - F.col("number")).alias("next"))
    span = F.max("us") - F.min("us")
    spans = instants.groupBy(KEY).agg(span.alias("span"), F.count(F.lit(1)).alias("n"))
    longest, most = spans.agg(F.max("span"), F.max("n")).first()
    jumps = jumps.join(F.broadcast(spans.select(KEY, "n")), KEY).filter("next < n").select(KEY, "number", "next")
    reached = spans.select(KEY, F.lit(0).cast("bigint").alias("number"))
    rounds = math.ceil(math.log2(min(longest // micros + 1, most))) if most else 0
    for turn in range(rounds):
        further = reached.join(jumps, [KEY, "number"]).select(KEY, F.col("next").alias("number"))
        reached = reached.unionByName(further)
        if turn + 1 < rounds:
            onward = jumps.select(KEY, F.col("number").alias("next"), F.col("next").alias("_next"))
            jumps = jumps.join(onward, [KEY, "next"]).select(KEY, "number", F.col("_next").alias("next"))
        if turn % CUT == CUT - 1:
            reached, jumps = _staged(reached, "reached"), _staged(jumps, "jumps")
    accepted = _staged(reached.join(instants, [KEY, "number"]).select(KEY, "us", "first"), "accepted")
    own = ((F.col("us") - F.pmod("us", F.lit(micros))) / F.lit(micros)).cast("bigint").alias("_block")
    nothing = F.lit(None).cast(accepted.schema["first"].dataType)
    here = accepted.select(KEY, own, F.col("first").alias("_here"), nothing.alias("_before"))
    before = accepted.select(KEY, (own + 1).alias("_block"), nothing.alias("_here"), F.col("first").alias("_before"))
    marks = here.unionByName(before).groupBy(KEY, "_block").agg(F.max("_here").alias("_here"), F.max("_before").alias("_before"))
    if accepted.count() <= MAX_BROADCAST_MARKS:
        joined = staged.join(F.broadcast(marks), [KEY, "_block"], "left")
    else:
        salted = marks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = staged.withColumn("_salt", F.pmod("_copy", F.lit(SALTS)).cast("int")).join(salted, [KEY, "_block", "_salt"], "left")
    joined = joined.withColumn("_cur", F.col("_here.place"))
    last = F.when(F.col("_cur") <= F.col("_place"), F.col("_cur")).otherwise(F.coalesce("_before.place", "_seed"))
    marked = _mark(joined, F.col("_here.copy") == F.col("_copy"), last)
    return marked.select(*rows.columns, "accepted", "dedup_reason")


def _staged(rows: DataFrame, name: str) -> DataFrame:
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def first_wins(rows: DataFrame) -> DataFrame:
    """The first delivery of every key, without expiry: the cheap path, combined map-side."""
    return rows.groupBy(KEY).agg(
        F.min(delivery_place()).alias("first"), F.count(F.lit(1)).alias("deliveries")
    ).select(KEY, "first.*", "deliveries").withColumnRenamed("us", "arrival_us")
