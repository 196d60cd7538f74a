"""Hard negatives by exact integer products, several candidates to one wide integer.

A component x becomes the integer floor(256 x). For a batch of candidates a bias makes all components non-negative; the
components of several candidates go into separate fields of one wide integer, each field wide enough for the largest sum of
products that these rows can have. One multiplication for each anchor component then serves all candidates of the integer,
and the fields of the sum are the exact scores, less what the bias added. While sums fit a double's 53 bits the integers are
kept in doubles, so that the multiplications are a matrix product; beyond that they are integers of any length.

Anchors are dealt into blocks of bounded size. A block is broadcast and every partition of candidates keeps the best of its
rows for each anchor: first the positives, then, with the positives' scores known, the negatives within each one's bounds.
The candidates are not shuffled, and what is merged is a few rows for each anchor and partition.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.components import written
from keyflow.session import scratch_path

SCALE = 256.0
POSITIVES = 5
NEGATIVES = 3
#: Negatives have at least 50 and at most 95 percent of the positive's score.
LEAST_PERCENT, MOST_PERCENT = 50, 95
#: A block of anchors: so many components and so many rows, about (anchors are dealt by hash).
BLOCK_COMPONENTS = 1 << 22
BLOCK_ANCHORS = 1 << 16
#: Candidates that are packed at once, and scores that are held at once.
BATCH_ROWS = 8192
CELLS = 1 << 21
DOUBLE_BITS = 53
LARGEST = (1 << 63) - 1
#: Stands for a missing id, which comes after all others.
NO_ID = LARGEST


def wide_products(anchors: np.ndarray, candidates: np.ndarray, bits: int) -> np.ndarray:
    """Sums of products of non-negative integers of any size below ``2 ** bits``: one integer holds a component of all
    candidates. Sums beyond a long become the largest long."""
    width = (bits + 7) // 8
    columns = []
    for column in candidates.T.tolist():
        columns.append(int.from_bytes(b"".join(int(x).to_bytes(width, "little") for x in column), "little"))
    out = np.empty((len(anchors), len(candidates)), object)
    for row, anchor in enumerate(anchors.tolist()):
        total = sum(int(x) * column for x, column in zip(anchor, columns, strict=True))
        packed = total.to_bytes(width * len(candidates), "little")
        out[row] = [int.from_bytes(packed[at : at + width], "little") for at in range(0, len(packed), width)]
    return out


def double_products(anchors: np.ndarray, candidates: np.ndarray, bits: int) -> np.ndarray:
    """The same with as many fields as a double holds exactly; all partial sums are whole numbers below 2 ** 53."""
    fields = max(1, DOUBLE_BITS // bits)
    groups = -(-len(candidates) // fields)
    packed = np.zeros((groups, candidates.shape[1]))
    for field in range(fields):
        part = candidates[field * groups : (field + 1) * groups]
        packed[: len(part)] += part * 2.0 ** (bits * field)
    sums = (anchors @ packed.T).astype(np.int64)
    mask = np.int64((1 << bits) - 1)
    out = [(sums >> np.int64(bits * field)) & mask for field in range(fields)]
    return np.concatenate(out, axis=1)[:, : len(candidates)]


def scores_of(anchors: np.ndarray, candidates: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers held in doubles; ``anchors`` by ``candidates``, beyond a long its ends."""
    if not anchors.shape[1]:
        return np.zeros((len(anchors), len(candidates)), np.int64)
    low_a, low_c = anchors.min(), candidates.min()
    dims = anchors.shape[1]
    with np.errstate(all="ignore"):
        a, c = anchors - low_a, candidates - low_c
        most = float(a.max(axis=0) @ c.max(axis=0))
        biases = dims * max(1.0, abs(low_a)) * max(1.0, abs(low_c), float(c.max())) + dims * abs(low_c) * float(a.max())
    if max(most, biases, abs(low_a), abs(low_c)) < 2.0 ** (DOUBLE_BITS - 1):
        bits = max(1, int(most).bit_length())
        sums = double_products(a, c, bits)
        shift = np.int64(low_c) * a.sum(axis=1).astype(np.int64)[:, None] + np.int64(low_a) * c.sum(axis=1).astype(np.int64)[None, :]
        return sums + shift + np.int64(dims) * np.int64(low_a) * np.int64(low_c)
    low_a, low_c = int(low_a), int(low_c)
    a = np.array([[int(x) - low_a for x in row] for row in anchors.tolist()], object).reshape(anchors.shape)
    c = np.array([[int(x) - low_c for x in row] for row in candidates.tolist()], object).reshape(candidates.shape)
    bits = max(1, (dims * int(a.max()) * int(c.max())).bit_length())
    sums = wide_products(a, c, bits) + low_c * a.sum(axis=1)[:, None] + low_a * c.sum(axis=1)[None, :] + dims * low_a * low_c
    return np.clip(sums, -LARGEST, LARGEST).astype(np.int64)


def components(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Rows that take part, by vector length: row numbers and their components as whole numbers."""
    if isinstance(vectors, pa.ChunkedArray):
        vectors = vectors.combine_chunks()
    values = vectors.values
    plain = values.to_numpy(zero_copy_only=False).astype(np.float64)
    with np.errstate(over="ignore"):
        plain = np.floor(SCALE * plain)
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(plain))])
    offsets = vectors.offsets.to_numpy().astype(np.int64)
    usable = (bad[offsets[1:]] == bad[offsets[:-1]]) & vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.diff(offsets)
    out = {}
    for length in np.unique(lengths[usable]).tolist():
        rows = np.flatnonzero(usable & (lengths == length))
        out[length] = rows, plain[offsets[rows][:, None] + np.arange(length)]
    return out


def stretches(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """Batches put together until they have ``rows`` rows."""
    held, size = [], 0
    for batch in batches:
        held.append(batch)
        size += batch.num_rows
        if size >= rows:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


class Best:
    """The best so far of every slot: highest score first, then smallest id."""

    def __init__(self, slots: int, keep: int):
        self.keep = keep
        self.scores = np.full((slots, keep), -LARGEST - 1, np.int64)
        self.ids = np.full((slots, keep), NO_ID, np.int64)
        self.found = np.zeros(slots, np.int64)

    def worst(self, slots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Score and id that a new row must come before; any row does in a slot that is not full."""
        return self.scores[slots, -1][:, None], self.ids[slots, -1][:, None]

    def offer(self, slots: np.ndarray, scores: np.ndarray, ids: np.ndarray) -> None:
        if not len(slots):
            return
        touched = np.unique(slots)
        old_slot, old_place = np.nonzero(np.arange(self.keep) < self.found[touched][:, None])
        old_slot = touched[old_slot]
        slots = np.concatenate([old_slot, slots])
        scores = np.concatenate([self.scores[old_slot, old_place], scores])
        ids = np.concatenate([self.ids[old_slot, old_place], ids])
        order = np.lexsort((ids, -scores, slots))
        slots, scores, ids = slots[order], scores[order], ids[order]
        first = np.searchsorted(slots, slots, "left")
        rank = np.arange(len(slots)) - first
        kept = rank < self.keep
        self.scores[slots[kept], rank[kept]] = scores[kept]
        self.ids[slots[kept], rank[kept]] = ids[kept]
        self.found[slots[kept]] = rank[kept] + 1


def better(scores: np.ndarray, ids: np.ndarray, worst: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    score, last = worst
    return (scores > score) | ((scores == score) & (ids[None, :] < last))


class Anchors:
    """A block of anchors: for each vector length, the rows with it and their components."""

    def __init__(self, table: pa.Table):
        self.numbers = table["_n"].to_numpy()
        self.ids = table["_id"].fill_null(NO_ID).to_numpy()
        self.labels = table["_label"].to_numpy()
        self.rows = components(table["_vector"])
        self.own = np.zeros(len(self.ids), np.int64)
        for rows, parts in self.rows.values():
            for row, part in zip(rows.tolist(), parts, strict=True):
                self.own[row] = scores_of(part[None, :], part[None, :])[0, 0]


def chunks(rows: np.ndarray, parts: np.ndarray, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    step = max(1, CELLS // max(1, width))
    for at in range(0, len(rows), step):
        yield rows[at : at + step], parts[at : at + step]


def candidates_of(batches: Iterator[pa.RecordBatch], anchors: Anchors) -> Iterator[tuple]:
    """Candidates and anchors of the same vector length: ids, labels and components of both."""
    for table in stretches(batches, BATCH_ROWS):
        ids, labels = table["_id"].fill_null(NO_ID).to_numpy(), table["_label"].to_numpy()
        for length, (rows, parts) in components(table["_vector"]).items():
            if length in anchors.rows:
                yield ids[rows], labels[rows], parts, *anchors.rows[length]


def best_positives(batches: Iterator[pa.RecordBatch], anchors: Anchors, keep: int) -> Best:
    best = Best(len(anchors.ids), keep)
    for ids, labels, parts, slots, own in candidates_of(batches, anchors):
        of_anchor = anchors.labels[slots]
        for label in np.unique(labels).tolist():
            here, there = np.flatnonzero(labels == label), np.flatnonzero(of_anchor == label)
            for some, vectors in chunks(slots[there], own[there], len(here)):
                scores = scores_of(vectors, parts[here])
                hit = better(scores, ids[here], best.worst(some))
                if len(here) > keep and (best.found[some] < keep).any():
                    least = np.partition(scores, len(here) - keep, axis=1)[:, len(here) - keep]
                    hit &= scores >= least[:, None]
                row, column = np.nonzero(hit)
                best.offer(some[row], scores[row, column], ids[here][column])
    return best


def bounds(positive: np.ndarray, least: int = LEAST_PERCENT, most: int = MOST_PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest score of a negative: ``least * p <= 100 * s <= most * p`` in whole numbers, without overflow."""
    whole, rest = positive // 100, positive % 100
    return least * whole + -(-least * rest // 100), most * whole + most * rest // 100


def best_negatives(batches: Iterator[pa.RecordBatch], anchors: Anchors, positive: np.ndarray, n: np.ndarray, keep: int) -> Best:
    """``positive``: scores of each anchor's positives, ``n`` their number; slots are anchor times positive."""
    each = positive.shape[1]
    best = Best(len(anchors.ids) * each, keep)
    low, high = bounds(positive)
    for ids, labels, parts, slots, own in candidates_of(batches, anchors):
        for some, vectors in chunks(slots, own, len(ids)):
            scores = scores_of(vectors, parts)
            other = anchors.labels[some][:, None] != labels[None, :]
            for place in range(each):
                inside = other & (scores >= low[some, place][:, None]) & (scores <= high[some, place][:, None])
                inside &= (n[some] > place)[:, None]
                if inside.any():
                    hit = inside & better(scores, ids, best.worst(some * each + place))
                    row, column = np.nonzero(hit)
                    best.offer(some[row] * each + place, scores[row, column], ids[column])
    return best


def best_rows(best: Best, names: list[str]) -> tuple[np.ndarray, pa.RecordBatch]:
    slot, place = np.nonzero(np.arange(best.keep) < best.found[:, None])
    ids = best.ids[slot, place]
    columns = [pa.array(slot, pa.int64()), pa.array(best.scores[slot, place], pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID)]
    return slot, pa.RecordBatch.from_arrays(columns, names)


def top(rows: DataFrame, by: list[str], score: str, id_col: str, keep: int, rank: str) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc(score), F.asc_nulls_last(id_col))
    return rows.withColumn(rank, F.row_number().over(order)).where(F.col(rank) <= keep)


def own_removed(anchors: Anchors, table: pa.Table, keep: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Scores and ids of each anchor's positives and how many there are: its ``keep + 1`` best of the label, less itself.

    A row equal to the anchor in id and score can't be told from it, so one of them goes, whichever it is."""
    slot, score = table["slot"].to_numpy(), table["score"].to_numpy()
    ids = table["id"].fill_null(NO_ID).to_numpy()
    order = np.lexsort((ids, -score, slot))
    slot, score, ids = slot[order], score[order], ids[order]
    own = np.flatnonzero((ids == anchors.ids[slot]) & (score == anchors.own[slot]))
    own = own[np.unique(slot[own], return_index=True)[1]]
    slot, score, ids = (np.delete(x, own) for x in (slot, score, ids))
    rank = np.arange(len(slot)) - np.searchsorted(slot, slot, "left")
    kept = rank < keep
    scores_out, ids_out = np.zeros((len(anchors.ids), keep), np.int64), np.full((len(anchors.ids), keep), NO_ID, np.int64)
    scores_out[slot[kept], rank[kept]], ids_out[slot[kept], rank[kept]] = score[kept], ids[kept]
    return scores_out, ids_out, np.bincount(slot[kept], minlength=len(anchors.ids))


def mine(
    vectors: DataFrame,
    anchor: Column,
    label: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    block_components: int = BLOCK_COMPONENTS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` for the rows that ``anchor`` selects.

    Scores are inner products of the components ``floor(256 x)``. An anchor's positives are the best other rows of its
    ``label``; each one's negatives are the best rows of other labels with 50 to 95 percent of the positive's score. Higher
    scores come first, ties by smaller id, a missing id last. A row without label or vector, or with a null or non-finite
    component, takes no part; neither does a component that 256 times leaves the doubles. Vectors of different lengths are
    not compared; those of length 0 have score 0. Rows that share an id are rows of their own, and so are repeated
    rows, as anchors, positives and negatives. Scores beyond a long become its ends. A positive score below 0 has no
    negatives. An empty table gives no rows; other columns are not read.
    """
    spark = vectors.sparkSession
    rows = vectors.select(
        F.col(id_col).cast("long").alias("_id"), label.cast("long").alias("_label"), F.col(vector_col).alias("_vector"), anchor.alias("_anchor")
    ).where("_label IS NOT NULL AND _vector IS NOT NULL")
    chosen = written(rows.where("_anchor").select("_id", "_label", "_vector", F.monotonically_increasing_id().alias("_n")), "anchors")
    size = chosen.agg(F.count("*"), F.sum(F.size("_vector"))).first()
    blocks = max(math.ceil(size[0] / block_anchors), math.ceil((size[1] or 0) / block_components))
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not blocks:
        return spark.createDataFrame([], schema)
    rows = rows.select("_id", "_label", "_vector")
    tasks = spark.sparkContext.defaultParallelism
    if rows.rdd.getNumPartitions() < tasks:
        rows = rows.repartition(tasks)
    folder = scratch_path(spark, "negatives")
    for block in range(blocks):
        of_block = F.pmod(F.xxhash64("_n"), F.lit(blocks)) == block
        anchors = Anchors(chosen.where(of_block).toArrow())
        sent = spark.sparkContext.broadcast(anchors)

        def first(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            yield best_rows(best_positives(batches, sent.value, positives + 1), ["slot", "score", "id"])[1]

        found = top(rows.mapInArrow(first, "slot long, score long, id long"), ["slot"], "score", "id", positives + 1, "_rank")
        scores, ids, n = own_removed(anchors, found.select("slot", "score", "id").toArrow(), positives)
        known = spark.sparkContext.broadcast((scores, ids, n))

        def second(batches: Iterator[pa.RecordBatch], sent=sent, known=known) -> Iterator[pa.RecordBatch]:
            scores, ids, n = known.value
            best = best_negatives(batches, sent.value, scores, n, negatives)
            slot, rows = best_rows(best, ["slot", "negative_score", "negative_id"])
            anchor, place = np.divmod(slot, positives)
            more = {"anchor_id": sent.value.ids[anchor], "positive_id": ids[anchor, place], "positive_score": scores[anchor, place]}
            for name, values in more.items():
                missing = values == NO_ID if name.endswith("_id") else None
                rows = rows.append_column(name, pa.array(values, pa.int64(), mask=missing))
            yield rows

        out = "slot long, negative_score long, negative_id long, anchor_id long, positive_id long, positive_score long"
        merged = top(rows.mapInArrow(second, out), ["slot"], "negative_score", "negative_id", negatives, "rank")
        merged.drop("slot").write.parquet(f"{folder}/block={block}")
        for used in (sent, known):
            used.destroy()
    names = [part.split()[0] for part in schema.split(", ")]
    stored = spark.read.schema(schema).parquet(*(f"{folder}/block={block}" for block in range(blocks)))
    return stored.select(*names)


def relabelled(id_col: str = "vec_id", label_col: str = "label") -> Column:
    """The label; of every seventh id the next one."""
    label = F.col(label_col)
    return F.when(F.col(id_col) % 7 == 0, (label + 1) % 10).otherwise(label)


SQL = """
WITH usable AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x::DOUBLE))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS same,
         list_inner_product(a.v, b.v)::BIGINT AS score
  FROM usable a JOIN usable b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, p.positive_score, s.other_id AS negative_id, s.score AS negative_score,
       row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)::INTEGER AS rank
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
  AND 50 * p.positive_score <= 100 * s.score AND 100 * s.score <= 95 * p.positive_score
QUALIFY rank <= 3
"""
