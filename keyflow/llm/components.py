"""Connected components of a link table, by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.session import scratch_path


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame, written to the shared folder and read back: later steps neither recompute it nor carry its plan."""
    spark = frame.sparkSession
    path = scratch_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def large_star(links: DataFrame) -> DataFrame:
    """Each node's larger neighbours are tied to its smallest neighbour."""
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("root"))
    return both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("root").alias("b")).distinct()


def small_star(links: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours are tied to the smallest of them."""
    down = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("root"))
    tied = down.join(least, "a").where("b <> root").select(F.col("b").alias("a"), F.col("root").alias("b"))
    return tied.unionByName(least.select("a", F.col("root").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """``a, b`` links to ``node, root``: each linked node with the smallest node it reaches, itself left out where it is
    the root. Minima combine before the shuffle and no neighbourhood is ever collected; the rounds grow with the
    logarithm of the longest path."""
    links = written(links.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        links = written(small_star(large_star(links)), "links")
        now = tuple(links.agg(F.count("*"), F.sum(F.hash("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("a", "b"))).first())
        if now == state:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        state = now
