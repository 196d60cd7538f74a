"""Dense sequence numbers per group at scale: 0, 1, 2, ... in order, with no group in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from keyflow.session import scratch_path

SLICE = 100_000
MAX_BROADCAST_RUNS = 100_000


def staged_numbers(rows: DataFrame, group: str, order: list[str], name: str) -> DataFrame:
    """Add ``name``: the number of each row within its group, for any order columns.

    Rows are range-partitioned and sorted by (group, order), so any group spreads over many tasks.
    They are written once with task and row number, because range bounds are sampled and must not
    be drawn twice; each row's number is then its place in the task plus the rows of earlier tasks.
    """
    spark = rows.sparkSession
    path = scratch_path(spark, "numbered")
    place = F.monotonically_increasing_id()
    (
        rows.repartitionByRange(group, *order)
        .sortWithinPartitions(group, *order)
        .withColumns({"_task": F.shiftright(place, 33), "_row": place.bitwiseAND(F.lit((1 << 33) - 1))})
        .write.parquet(path)
    )
    staged = spark.read.parquet(path)
    # one row per task and group in it
    runs = staged.groupBy(group, "_task").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first")
    )
    earlier = Window.partitionBy(group).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    base = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    bases = runs.select(group, "_task", base.alias("_base"))
    if runs.limit(MAX_BROADCAST_RUNS + 1).count() <= MAX_BROADCAST_RUNS:
        bases = F.broadcast(bases)
    numbered = staged.join(bases, [group, "_task"])
    return numbered.withColumn(name, F.col("_base") + F.col("_row")).drop("_base", "_row", "_task")


def offset_numbers(rows: DataFrame, name: str, slice_size: int = SLICE) -> DataFrame:
    """Add ``name``: the number of each row in its topic and partition, in offset order.

    Offsets are distinct here but may have gaps. A slice of the offset range holds at most
    ``slice_size`` rows, so numbering within slices is bounded; the slices' counts give the rest.
    """
    size = F.lit(slice_size)
    sliced = rows.withColumn("_slice", F.col("offset") - F.pmod(F.col("offset"), size))
    group = ["topic", "partition", "_slice"]
    counts = sliced.groupBy(*group).agg(F.count(F.lit(1)).alias("_n"))
    earlier = (
        Window.partitionBy("topic", "partition")
        .orderBy("_slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    bases = counts.select(*group, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_base"))
    within = F.row_number().over(Window.partitionBy(*group).orderBy("offset")) - 1
    numbered = sliced.withColumn("_in", within).join(bases, group)
    return numbered.withColumn(name, F.col("_base") + F.col("_in")).drop("_slice", "_in", "_base")
