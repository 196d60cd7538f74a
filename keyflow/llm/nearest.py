"""Approximate nearest neighbours by inner product: inverted lists and an adaptive scan of dimensions.

Vectors get one more component that brings all to the same length, so the largest inner product is the least distance.
Centroids are fitted on a bounded sample; every row goes to the list of its nearest centroid, and a query probes the
lists nearest to it. Within a list, vectors are rotated at random and compared in blocks of columns: after each block
the distance is estimated from the columns seen, and a candidate goes when the hypothesis that it is nearer than the
query's present 20th cannot be held any more. What is left is scored on the original vectors. Lists are split into blocks of
rows, and so are queries, so a vector that a third of all rows share is many tasks.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keyflow.llm.common import small_batches

NEIGHBOURS = 20
#: Components in the sample that the centroids are fitted on, about, and rounds of fitting.
SAMPLE_VALUES = 2_000_000
ROUNDS = 8
#: Lists: the square root of the rows up to this; share of the lists that a query probes, and the least number.
LISTS = 64
PROBE_SHARE = 0.7
LEAST_PROBES = 8
#: Rows of a list, or queries, that one task holds.
BLOCK_ROWS = 20_000
COLUMNS = 16
#: How many standard errors an estimate may lie above the present threshold.
ERRORS = 2.5
SEED = 20


@dataclass
class Index:
    """What tasks need to place a vector: bounded by ``LISTS`` and the dimension."""

    dimension: int
    longest: float
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int

    def rotated(self, vectors: np.ndarray, query: bool) -> np.ndarray:
        rest = np.zeros(len(vectors)) if query else np.sqrt(np.maximum(self.longest - (vectors * vectors).sum(axis=1), 0))
        return np.column_stack([vectors, rest]) @ self.rotation

    def order(self, rotated: np.ndarray, n: int) -> np.ndarray:
        """The ``n`` lists nearest to each vector."""
        far = (self.centroids * self.centroids).sum(axis=1) - 2 * rotated @ self.centroids.T
        return np.argsort(far, axis=1, kind="stable")[:, :n]


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``vec_id, vector, norm``: rows with an id and a finite vector that is not zero."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    norm = F.aggregate("vector", F.lit(0.0), lambda total, x: total + x * x)
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf))
    return rows.where(F.col("vec_id").isNotNull() & F.col("vector").isNotNull() & finite).withColumn("norm", norm).where("norm > 0")


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    values = lists.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(lists), -1) if len(lists) else np.empty((0, 0))


def centroids_of(points: np.ndarray, lists: int, rounds: int) -> np.ndarray:
    rng = np.random.default_rng(SEED)
    centers = points[rng.choice(len(points), min(lists, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = np.concatenate([((centers * centers).sum(axis=1) - 2 * part @ centers.T).argmin(axis=1) for part in np.array_split(points, max(1, len(points) // 4096))])
        counts = np.bincount(nearest, minlength=len(centers))
        sums = np.zeros_like(centers)
        np.add.at(sums, nearest, points)
        centers = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centers)
    return centers


def fit(rows: DataFrame, lists: int = LISTS, sample_values: int = SAMPLE_VALUES, probe_share: float = PROBE_SHARE) -> Index | None:
    """Centroids of a sample chosen by a hash of the id; the length and the number of rows come from all rows."""
    shape = rows.groupBy(F.size("vector").alias("d")).agg(F.count("*").alias("n"), F.max("norm").alias("m")).orderBy(F.desc("n"), "d").first()
    if shape is None:
        return None
    dimension, n, longest = shape["d"], shape["n"], shape["m"]
    share = F.pmod(F.xxhash64("vec_id"), F.lit(1 << 30)) / float(1 << 30)
    sample = rows.where((F.size("vector") == dimension) & (share < sample_values / dimension / n)).select("vec_id", "vector").orderBy("vec_id").toArrow()
    rng = np.random.default_rng(SEED)
    rotation = np.linalg.qr(rng.standard_normal((dimension + 1, dimension + 1)))[0]
    index = Index(dimension, longest, rotation, np.zeros((1, dimension + 1)), 1)
    if sample.num_rows:
        points = index.rotated(matrix(sample["vector"]), False)
        index.centroids = centroids_of(points, max(1, min(lists, math.isqrt(n))), ROUNDS)
        index.probes = min(len(index.centroids), max(LEAST_PROBES, math.ceil(probe_share * len(index.centroids))))
    return index


def nearest(index: Index, ids: np.ndarray, vectors: np.ndarray, rotated: np.ndarray, own: int, query: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Ids and scores of the nearest candidates of one query in one block."""
    at = np.flatnonzero(ids != own)
    target = index.rotated(query[None, :], True)[0]
    total = rotated.shape[1]
    if len(at) > k:
        some = at[:: max(1, len(at) // (4 * k))]
        exact = ((rotated[some] - target) ** 2).sum(axis=1)
        threshold = np.partition(exact, k - 1)[k - 1] if len(some) >= k else math.inf
        part = np.zeros(len(at))
        for begin in range(0, total, COLUMNS):
            end = min(begin + COLUMNS, total)
            part += ((rotated[at, begin:end] - target[begin:end]) ** 2).sum(axis=1)
            slack = 1 + ERRORS / math.sqrt(end) if end < total else 1 + 1e-9
            near = part * (total / end) <= threshold * slack * slack
            at, part = at[near], part[near]
    scores = (vectors[at] * query).sum(axis=1)
    best = np.lexsort((ids[at], -scores))[:k]
    return ids[at][best], scores[best]


def search(vectors: DataFrame, is_query: Column, k: int = NEIGHBOURS, id_col: str = "vec_id", vector_col: str = "embedding", **fitting) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``is_query`` (a condition on ``vec_id``) holds for, the ``k``
    rows with the largest inner product that its lists have; ties go to the smaller id.

    Null, zero and non-finite vectors, rows without id and vectors of another length than most take no part. Rows with the
    query's id are its own; repeated rows of another id are candidates each. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    rows = usable(vectors, id_col, vector_col)
    schema = "query_id long, vec_id long, score double"
    if (index := fit(rows, **fitting)) is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = rows.where(F.size("vector") == index.dimension).select("vec_id", "vector")

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists = index.order(index.rotated(matrix(batch["vector"]), False), 1)[:, 0]
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.astype(np.int32))], ["vec_id", "vector", "list"])

    listed = rows.mapInArrow(placed, "vec_id long, vector array<double>, list int")
    sizes = {row["list"]: -(-row["n"] // BLOCK_ROWS) for row in listed.groupBy("list").agg(F.count("*").alias("n")).collect()}
    query_blocks = max(1, -(-rows.where(is_query).count() // BLOCK_ROWS))

    def probed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            lists = index.order(index.rotated(matrix(batch["vector"]), True), index.probes)
            take, where, block = [], [], []
            for row, probes in enumerate(lists.tolist()):
                for one in probes:
                    for part in range(sizes.get(one, 0)):
                        take.append(row)
                        where.append(one)
                        block.append(part)
            rows = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(where, pa.int32()), pa.array(block, pa.int32())], ["vec_id", "vector", "list", "block"])

    def compared(key: tuple, candidates: pa.Table, queries: pa.Table) -> pa.Table:
        ids, points = candidates["vec_id"].to_numpy(), matrix(candidates["vector"])
        owners, wanted = queries["vec_id"].to_numpy(), matrix(queries["vector"])
        out: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if len(ids):
            order = np.argsort(ids, kind="stable")
            ids, points = ids[order], points[order]
            rotated = index.rotated(points, False)
            for owner, query in zip(owners.tolist(), wanted, strict=True):
                found, scores = nearest(index, ids, points, rotated, owner, query, k)
                out.append((np.full(len(found), owner, np.int64), found, scores))
        columns = [np.concatenate(x) for x in zip(*out, strict=True)] if out else [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)]
        return pa.table(dict(zip(("query_id", "vec_id", "score"), columns, strict=True)))

    counts = F.create_map(*(F.lit(x) for pair in sizes.items() for x in pair)) if sizes else F.create_map(F.lit(0), F.lit(1))
    block = F.pmod(F.xxhash64("vec_id"), counts[F.col("list")].cast("long")).cast("int")
    candidates = listed.withColumn("block", block).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
    queries = (
        rows.where(is_query)
        .mapInArrow(probed, "vec_id long, vector array<double>, list int, block int")
        .withColumn("part", F.pmod(F.xxhash64("vec_id"), F.lit(query_blocks)).cast("int"))
    )
    keys = ["list", "block", "part"]
    found = candidates.groupBy(*keys).cogroup(queries.groupBy(*keys)).applyInArrow(compared, schema)
    nearest_first = W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(nearest_first)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
