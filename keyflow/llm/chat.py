"""Chat formatting with cumulative snapshots collapsed, in DataFrame operations only.

A log often holds a conversation several times, each time with more turns. Every turn gets a hash of its number, role
and text; their running sums identify the prefix of a conversation that ends there, whatever conversation it is in. A
conversation whose whole hash is a prefix of a longer one, or of an equal one with a smaller id, goes. Prefixes are
reduced to one row per hash, map-side first, with the longest conversation that has it and the least one that ends there;
so a prefix that very many share is one row, and those rows say themselves which conversations stay. Running
sums are taken within blocks of turn numbers and added up over blocks, and a long conversation is rendered in parts, so no
conversation has to fit one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Turn numbers per block of running sums and per rendered part.
PART_TURNS = 1024
TURN_START, TURN_END = "<|im_start|>", "<|im_end|>"
NO_TURN = -(1 << 63)
SUMS = ["_n", "_a", "_b", "_c", "_d"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """Distinct turns under fixed names. Null roles are ``unknown``, null texts empty, null turn numbers come first."""
    return conversations.select(
        F.col("conv_id"),
        F.coalesce(F.col("turn").cast("long"), F.lit(NO_TURN)).alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    ).distinct()


def part_of(turn: Column, part_turns: int) -> Column:
    return F.floor(turn / F.lit(part_turns)).cast("long")


def sums() -> list[Column]:
    """128 bits of hash per turn, as four sums that cannot overflow, and the number of turns."""
    halves = []
    for seed in (0, 1):
        value = F.xxhash64(F.lit(seed), "turn", "role", "text")
        halves += [value.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(value, 32)]
    return [F.count("*").alias("_n"), *(F.sum(half).alias(name) for half, name in zip(halves, SUMS[1:], strict=True))]


def prefixes(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """For each turn number of a conversation: the sums over all turns up to it."""
    by_turn = turns.groupBy("conv_id", "turn").agg(*sums()).withColumn("_part", part_of(F.col("turn"), part_turns))
    by_part = by_turn.groupBy("conv_id", "_part").agg(*(F.sum(x).alias(x) for x in SUMS))
    earlier = W.partitionBy("conv_id").orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    before = by_part.select(F.col("conv_id").alias("_conv"), F.col("_part").alias("_p"), *(F.coalesce(F.sum(x).over(earlier), F.lit(0)).alias(f"{x}0") for x in SUMS))
    within = W.partitionBy("conv_id", "_part").orderBy("turn").rowsBetween(W.unboundedPreceding, W.currentRow)
    running = by_turn.select("conv_id", "turn", "_part", *(F.sum(x).over(within).alias(x) for x in SUMS))
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("_part") == F.col("_p"))
    return running.join(before, same).select("conv_id", "turn", *((F.col(x) + F.col(f"{x}0")).alias(x) for x in SUMS))


def maximal(turns: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, n_turns`` of conversations that are no prefix of a longer one; the smallest id of equal ones.

    A null id counts as one conversation, before all others.
    """
    ends = turns.groupBy(F.col("conv_id").alias("_conv")).agg(F.count("*").alias("_all"))
    grown = prefixes(turns, part_turns).join(ends, F.col("conv_id").eqNullSafe(F.col("_conv")))
    alike = grown.groupBy(*SUMS).agg(F.max("_all").alias("_longest"), F.min(F.when(F.col("_all") == F.col("_n"), F.struct("conv_id"))).alias("_first"))
    ended = alike.where(F.col("_first").isNotNull() & (F.col("_longest") <= F.col("_n")))
    return ended.select(F.col("_first.conv_id").alias("conv_id"), F.col("_n").alias("n_turns"))


def render(conversations: DataFrame, part_turns: int = PART_TURNS) -> DataFrame:
    """``conv_id, part, n_turns, text`` of each maximal conversation, turns in order of their number.

    ``part`` is the turn number divided by ``part_turns``; a conversation that is not that long has one row. ``n_turns``
    counts the whole conversation. Repeated rows count once; different rows with the same turn number stand in
    order of role and text. Prefixes are told by turn numbers: a log that numbers turns anew is another one.
    """
    turns = turns_of(conversations)
    kept = maximal(turns, part_turns).withColumnRenamed("conv_id", "_conv")
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", "text")))
    parts = (
        turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
        .groupBy("conv_id", part_of(F.col("turn"), part_turns).alias("part"), "n_turns")
        .agg(ordered.alias("_turns"))
    )

    def written(x: Column) -> Column:
        return F.concat(F.lit(TURN_START), x["role"], F.lit("\n"), x["text"], F.lit(f"{TURN_END}\n"))

    return parts.select("conv_id", "part", "n_turns", F.array_join(F.transform("_turns", written), "").alias("text"))


SQL = f"""
WITH turns AS (
    SELECT DISTINCT conv_id, coalesce(turn, CAST('{NO_TURN}' AS BIGINT)) AS turn, coalesce(role, 'unknown') AS role, coalesce(text, '') AS body
    FROM conversations
), rendered AS (
    SELECT conv_id, turn, role, body, '{TURN_START}' || role || chr(10) || body || '{TURN_END}' || chr(10) AS piece FROM turns
), whole AS (
    SELECT conv_id, count(*) AS n_turns, string_agg(turn || '|' || piece, '' ORDER BY turn, role, body) AS text FROM rendered GROUP BY conv_id
), kept AS (
    SELECT conv_id, n_turns FROM whole a
    WHERE NOT EXISTS (
        SELECT 1 FROM whole b
        WHERE a.conv_id <> b.conv_id AND starts_with(b.text, a.text)
            AND (b.n_turns > a.n_turns OR (b.text = a.text AND b.conv_id < a.conv_id))
    )
)
SELECT conv_id, CAST(floor(turn / {PART_TURNS}) AS BIGINT) AS part, n_turns, string_agg(piece, '' ORDER BY turn, role, body) AS text
FROM rendered JOIN kept USING (conv_id) GROUP BY conv_id, part, n_turns
"""
