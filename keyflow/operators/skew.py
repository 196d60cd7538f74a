"""Hot keys: find them with a proven bound, and join around them."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow.session import scratch_path

# A key is heavy when it has more rows than HEAVY_FLOOR and more than 1/MAX_HEAVY_KEYS of all rows.
# So at most MAX_HEAVY_KEYS keys are heavy, whatever the data: that set can always be broadcast, and
# every other key holds at most max(HEAVY_FLOOR, total / MAX_HEAVY_KEYS) rows.
HEAVY_FLOOR = 100_000
MAX_HEAVY_KEYS = 200_000
# Keys that one sketch tracks; a fifth of them may be candidates.
TRACKED_KEYS = 100_000
# What is few for a hot key goes to so many places, its rows to one of them.
SALTS = 64


def heavy_keys(
    rows: DataFrame, key: str, floor: int = HEAVY_FLOOR, max_keys: int = MAX_HEAVY_KEYS
) -> DataFrame | None:
    """The heavy keys as a one-column table of at most ``max_keys`` rows, or None without any.

    One counting pass that combines map-side; the keys over the floor are written, so the set stays
    the same however often it is read.
    """
    spark, path, seen = rows.sparkSession, scratch_path(rows.sparkSession, "heavy"), Observation()
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0)).alias("total")
    counts.observe(seen, total).filter(F.col("n") > floor).write.parquet(path)
    limit = max(floor, seen.get["total"] // max_keys)
    schema = T.StructType([rows.schema[key], T.StructField("n", T.LongType())])
    heavy = spark.read.schema(schema).parquet(path).filter(F.col("n") > limit).select(key)
    return None if heavy.isEmpty() else heavy


def frequent_keys(rows: DataFrame, key: str, floor: int = HEAVY_FLOOR, tracked: int = TRACKED_KEYS) -> DataFrame | None:
    """The keys with more than ``floor`` rows as a one-column table, or None without any.

    One sketch over the key column names the candidates, without a shuffle and in memory that ``tracked`` bounds; their rows
    are then counted exactly. The sketch is sure of every key with more than ``3.5 / tracked`` of all rows, so
    a key that it misses has at most that share, and there are never more keys than it tracks.
    """
    spark = rows.sparkSession
    sketch = F.expr(f"approx_top_k({key}, {tracked // 5}, {tracked})")
    top = rows.filter(F.col(key).isNotNull()).agg(sketch.alias("top")).first()["top"] or []
    names = [(entry["item"],) for entry in top if entry["count"] > floor]
    if not names:
        return None
    candidates = spark.createDataFrame(names, T.StructType([rows.schema[key]]))
    counts = rows.select(key).join(F.broadcast(candidates), key).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    found = [(row[key],) for row in counts.filter(F.col("n") > floor).collect()]
    return spark.createDataFrame(found, T.StructType([rows.schema[key]])) if found else None


def split_heavy(rows: DataFrame, heavy: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Rows of heavy keys and all other rows; no shuffle."""
    small = F.broadcast(heavy)
    return rows.join(small, key, "left_semi"), rows.join(small, key, "left_anti")


def lookup_join(
    rows: DataFrame,
    lookup: DataFrame,
    key: str,
    floor: int = HEAVY_FLOOR,
    max_keys: int = MAX_HEAVY_KEYS,
) -> DataFrame:
    """Left join to a table with one row per key, of any size, that no hot key can slow down.

    Rows of heavy keys meet their few lookup rows by broadcast, rows without a key skip the join,
    and the rest is a plain shuffled join on keys of bounded size.
    """
    heavy = heavy_keys(rows, key, floor, max_keys)
    keyed, parts = rows, []
    if rows.schema[key].nullable:
        keyed = rows.filter(F.col(key).isNotNull())
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in lookup.schema if f.name != key]
        parts.append(rows.filter(F.col(key).isNull()).select("*", *missing))
    if heavy is not None:
        hot, keyed = split_heavy(keyed, heavy, key)
        hot_lookup = lookup.join(F.broadcast(heavy), key, "left_semi")
        parts.append(hot.join(F.broadcast(hot_lookup), key, "left"))
    joined = keyed.join(lookup, key, "left")
    for part in parts:
        joined = joined.unionByName(part)
    return joined
