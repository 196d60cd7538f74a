"""Near copies by a chosen-path set similarity join on word shingles.

A document is the set of its five-word shingles, and minwise hashing gives it tokens, one for each hash function. A tree
branches documents by one token: those that agree in it share a node. A node that is still large branches again by
further tokens, chosen by its path, several of them so that a pair gets several chances; what is large after the last level is
dealt into blocks at random, with the node's smallest document in each. Nodes and blocks are compared exhaustively. Independent
trees repeat this: a pair of similarity s is missed by one tree with probability 1 - s, by eight at 0.85 with 3 in 10 million.

Equal texts are one document here, so copies are never compared. Comparison is in two rounds. First each document of a
node proposes the link to the one most like it by tokens; these links are confirmed on the full sets and give components.
Then every pair of a node that the tokens leave possible and whose ends are still in different components is confirmed
on the full sets within the node, which sends on no more links than it has documents. At last the nodes that were dealt
into blocks are compared across them: documents outside the node's largest component meet all of its documents, one pair of
blocks to a task, so that no pair whose ends are still apart is left out.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import WORD, Memo, alone, identified, lowered, partitions, runs, small_batches, texts_of
from keyflow.llm.components import components, written

SHINGLE_WORDS = 5
SIMILARITY = 85
TOKENS = 64
TREES = 8
#: A node with more documents branches again, by so many tokens, at most so many times.
NODE_DOCS = 4096
#: Words whose hash a task remembers.
WORD_ENTRIES = 200_000
BRANCHES = 3
LEVELS = 2
#: How many standard errors the agreement of tokens may fall short of the similarity.
ERRORS = 5.0
RANDOM = np.random.default_rng(10).integers(1, 1 << 63, (2, TOKENS), dtype=np.uint64) | np.uint64(1)


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lowered(text)) if text else []


def shingles(words: list[str], hash_of, width: int = SHINGLE_WORDS) -> np.ndarray:
    """Distinct hashes of all runs of ``width`` words, sorted; of the whole text if it has fewer."""
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(hash_of, words), np.uint64, len(words))
    width = min(width, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for at in range(width):
        total = (total ^ hashes[at : at + len(total)]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(32)
    return np.unique(total + np.uint64(width))


def minwise(hashes: np.ndarray) -> np.ndarray:
    """One token of 32 bits for each hash function."""
    least = np.full(TOKENS, ~np.uint64(0), np.uint64)
    for begin in range(0, len(hashes), 4096):
        part = hashes[begin : begin + 4096, None] * RANDOM[0] + RANDOM[1]
        least = np.minimum(least, part.min(axis=0))
    return (least >> np.uint64(32)).astype("<u4")


def least_agreement(similarity: int) -> int:
    """Tokens that must agree; a linked pair falls below by chance about once in a million."""
    s = similarity / 100
    return max(1, math.floor(TOKENS * s - ERRORS * math.sqrt(TOKENS * s * (1 - s))))


def sketches(docs: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, key, tokens``: ``key`` is the same for texts with the same words."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("near copies")
        hash_of = Memo(xxhash.xxh64_intdigest, WORD_ENTRIES).__getitem__
        for batch in batches:
            sizes, keys, tokens = [], [], []
            for text in batch["text"].to_pylist():
                words = words_of(text)
                hashes = shingles(words, hash_of)
                sizes.append(len(hashes))
                keys.append(xxhash.xxh3_128_digest(" ".join(words)) if words else None)
                tokens.append(minwise(hashes).tobytes() if words else None)
            arrays = [batch["doc_id"], pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(tokens, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_shingles", "key", "tokens"])

    return docs.mapInArrow(sketched, "doc_id long, n_shingles long, key binary, tokens binary")


def token(at: Column | int) -> Column:
    """The token with number ``at`` of the packed column."""
    return F.hex(F.substring("tokens", at * 4 + 1, 4))


def nodes_of(texts: DataFrame, node_docs: int, levels: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """``node, id``: members of all nodes with two documents at least, large ones in blocks; and the large ones whole."""
    roots = F.array(*(F.xxhash64(F.lit(tree), token(tree)) for tree in range(trees)))
    now = written(texts.select("id", F.explode(roots).alias("node")), "nodes")
    found = []
    for level in range(levels + 1):
        sizes = now.groupBy("node").agg(F.count("*").alias("n"), F.min("id").alias("first")).where("n > 1")
        sized = now.join(sizes, "node")
        found.append(sized.where(F.col("n") <= node_docs).select("node", "id"))
        large = sized.where(F.col("n") > node_docs)
        if level == levels:
            dealt = written(large.select("node", "id").distinct(), "large")
            blocks = F.ceil(F.col("n") / node_docs).cast("int")
            block = F.pmod(F.xxhash64("id", "node"), blocks).cast("int")
            place = F.when(F.col("id") == F.col("first"), F.sequence(F.lit(0), blocks - 1)).otherwise(F.array(block))
            found.append(large.select(F.explode(place).alias("block"), "node", "id").select(F.xxhash64("node", "block").alias("node"), "id"))
        else:
            choice = [F.pmod(F.xxhash64("node", F.lit(branch)), F.lit(TOKENS)).cast("int") for branch in range(BRANCHES)]
            paths = F.array_distinct(F.array(*(F.xxhash64("node", at, token(at)) for at in choice)))
            now = written(large.join(texts.select("id", "tokens"), "id").select("id", F.explode(paths).alias("node")), "nodes")
    members = found[0]
    for more in found[1:]:
        members = members.unionByName(more)
    return written(members.distinct(), "members"), dealt


def across(dealt: DataFrame, roots: DataFrame, node_docs: int) -> DataFrame:
    """``node, id``: pairs of blocks of the large nodes, so that each two documents of a node with different roots share one.

    One end of such a pair is outside the node's most common root. These documents are dealt into blocks of ``node_docs``,
    and each block meets every block of the whole node.
    """
    of = dealt.join(roots.select("id", "root").distinct(), "id")
    by_root = of.groupBy("node", "root").agg(F.count("*").alias("n"))
    sizes = by_root.groupBy("node").agg(F.sum("n").alias("n"), F.max(F.struct("n", "root")).alias("most")).where("n > most.n")
    rows = of.join(sizes, "node").select(
        "node",
        "id",
        (F.col("root") != F.col("most.root")).alias("outside"),
        F.ceil((F.col("n") - F.col("most.n")) / node_docs).cast("int").alias("few"),
        F.ceil(F.col("n") / node_docs).cast("int").alias("all"),
    )

    def block(seed: int, blocks: str) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "id", "node"), F.col(blocks)).cast("int")

    def every(blocks: str) -> Column:
        return F.explode(F.sequence(F.lit(0), F.col(blocks) - 1))

    left = rows.where("outside").select("node", "id", block(1, "few").alias("i"), every("all").alias("j"))
    right = rows.select("node", "id", every("few").alias("i"), block(2, "all").alias("j"))
    return left.unionByName(right).select(F.xxhash64("node", "i", "j").alias("node"), "id").distinct()


def gathered(members: DataFrame, texts: DataFrame) -> DataFrame:
    """Members with the columns of their texts, the rows of a node next to each other."""
    rows = members.join(texts, "id")
    return rows.repartition(partitions(rows.sparkSession), "node").sortWithinPartitions("node", "id")


def sketch_rows(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    tokens = np.frombuffer(b"".join(table["tokens"].to_pylist()), "<u4").reshape(-1, TOKENS)
    return table["id"].to_numpy(), table["n_shingles"].to_numpy(), tokens


def alike(at: int, sizes: np.ndarray, tokens: np.ndarray, similarity: int, agreement: int, end: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Rows before ``end`` (earlier ones without it) that may be linked with row ``at``, and how many tokens agree."""
    end = at if end is None else end
    agree = (tokens[:end] == tokens[at]).sum(axis=1)
    small, large = np.minimum(sizes[:end], sizes[at]), np.maximum(sizes[:end], sizes[at])
    rows = np.flatnonzero((agree >= agreement) & (100 * small >= similarity * large))
    return rows, agree[rows]


def proposals(members: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """``a, b``: each document of a node with the earlier one most like it; ``a, a`` for all that are like another."""
    agreement = least_agreement(similarity)

    def proposed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("near copies")
        for table in runs(batches, "node"):
            ids, sizes, tokens = sketch_rows(table)
            pairs = set()
            for at in range(1, len(ids)):
                rows, agree = alike(at, sizes, tokens, similarity, agreement)
                if len(rows):
                    pairs.add((int(ids[at]), int(ids[rows[agree.argmax()]])))
                    pairs.update((x, x) for x in ids[rows].tolist())
            if pairs:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*pairs, strict=True)], ["a", "b"])

    return gathered(members, texts).select("node", "id", "n_shingles", "tokens").mapInArrow(proposed, "a long, b long").distinct()


def linked(first: np.ndarray, second: np.ndarray, similarity: int) -> bool:
    both = len(np.intersect1d(first, second, assume_unique=True))
    return 100 * both >= similarity * (len(first) + len(second) - both)


def confirmed(pairs: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """The pairs whose full sets are that similar."""

    def checked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("near copies")
        hash_of = Memo(xxhash.xxh64_intdigest, WORD_ENTRIES).__getitem__
        for batch in batches:
            sets = [[shingles(words_of(text), hash_of) for text in batch[x].to_pylist()] for x in ("text_a", "text_b")]
            yield batch.select(["a", "b"]).filter(pa.array([linked(x, y, similarity) for x, y in zip(*sets, strict=True)], pa.bool_()))

    with_a = pairs.join(full.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    rows = with_a.join(full.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    return rows.select("a", "b", "text_a", "text_b").mapInArrow(checked, "a long, b long")


def apart(members: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """Members, with columns, that the tokens leave possible as a link to one of their node with a different ``root``."""
    agreement = least_agreement(similarity)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("near copies")
        for table in runs(batches, "node"):
            ids, sizes, tokens = sketch_rows(table)
            roots, open_rows = table["root"].to_numpy(), set()
            _, place, n = np.unique(roots, return_inverse=True, return_counts=True)
            # one end of each pair with different roots is outside the most common one
            for at in np.flatnonzero(place != n.argmax()).tolist():
                rows, _ = alike(at, sizes, tokens, similarity, agreement, len(ids))
                rows = rows[roots[rows] != roots[at]]
                if len(rows):
                    open_rows.update([at, *rows.tolist()])
            if open_rows:
                yield from table.select(["node", "id", "n_shingles", "tokens", "root"]).take(sorted(open_rows)).to_batches()

    schema = "node long, id long, n_shingles long, tokens binary, root long"
    return gathered(members, texts).select("node", "id", "n_shingles", "tokens", "root").mapInArrow(split, schema)


def bridges(rows: DataFrame, full: DataFrame, similarity: int) -> DataFrame:
    """``a, b``: links between documents of a node that have different ``root`` s, of what ``apart`` found."""
    agreement = least_agreement(similarity)

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("near copies")
        hash_of = Memo(xxhash.xxh64_intdigest, WORD_ENTRIES).__getitem__
        for table in runs(batches, "node"):
            ids, sizes, tokens = sketch_rows(table)
            sets = [shingles(words_of(text), hash_of) for text in table["text"].to_pylist()]
            roots, found = table["root"].to_numpy().copy(), []
            for at in range(1, len(ids)):
                for row in alike(at, sizes, tokens, similarity, agreement)[0].tolist():
                    if roots[row] != roots[at] and linked(sets[row], sets[at], similarity):
                        found.append((int(ids[at]), int(ids[row])))
                        roots[roots == roots[at]] = roots[row]
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*found, strict=True)], ["a", "b"])

    together = rows.join(full, "id").repartition(partitions(rows.sparkSession), "node").sortWithinPartitions("node", "id")
    return together.select("node", "id", "n_shingles", "tokens", "root", "text").mapInArrow(joined, "a long, b long").distinct()


def rooted(texts: DataFrame, links: DataFrame) -> DataFrame:
    """Adds the smallest id that each document reaches."""
    roots = components(links).withColumnRenamed("node", "id")
    return texts.join(roots, "id", "left").withColumn("root", F.coalesce("root", "id"))


def classes(docs: DataFrame, similarity: int = SIMILARITY, node_docs: int = NODE_DOCS, levels: int = LEVELS, trees: int = TREES) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, one row per row of ``docs``.

    Words are runs without white space, A to Z in lower case. Two documents are linked if their sets of distinct shingles
    have ``100 * intersection >= similarity * union``; a text with fewer words is one shingle. ``component_id``
    is the smallest id that links reach. A null text or one without words has no shingles and is linked with
    nothing. A row without id is linked with nothing, has no component and is kept. Rows that share an id are one
    document with the links of all of them.
    """
    small_batches(docs.sparkSession)
    docs = identified(docs)
    rows = written(sketches(docs), "sketches")
    usable = rows.where("doc_id IS NOT NULL AND key IS NOT NULL")
    groups = written(usable.groupBy("key").agg(F.min("doc_id").alias("id")), "texts")
    texts = written(
        usable.join(groups.withColumnRenamed("key", "_key"), (F.col("doc_id") == F.col("id")) & (F.col("key") == F.col("_key")))
        .select("id", "n_shingles", "tokens")
        .distinct(),
        "texts",
    )
    members, dealt = nodes_of(texts, node_docs, levels, trees)
    pairs = written(proposals(members, texts, similarity), "pairs")
    wanted = pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id")))
    full = written(texts_of(docs, wanted).withColumnRenamed("doc_id", "id"), "full")
    links = written(confirmed(pairs.where("a <> b"), full, similarity), "links")
    roots = written(rooted(texts, links), "roots")
    more = written(links.unionByName(bridges(apart(members, roots, similarity), full, similarity)), "links")
    if not dealt.isEmpty():
        roots = written(rooted(texts, more), "roots")
        ends = written(apart(across(dealt, roots, node_docs), roots, similarity), "apart")
        full = written(texts_of(docs, ends.select(F.col("id").alias("doc_id"))).withColumnRenamed("doc_id", "id"), "full")
        more = written(more.unionByName(bridges(ends, full, similarity)), "links")
    roots = rooted(texts.select("id").distinct(), more)
    of_key = groups.join(roots, "id").select(F.col("key"), F.col("root"))
    component = F.coalesce("root", "doc_id")
    return rows.join(of_key, "key", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )


def deduplicated(docs: DataFrame, similarity: int = SIMILARITY) -> DataFrame:
    """The rows of ``docs``, all columns, of the smallest document of each class; rows without id stay."""
    gone = classes(docs, similarity).where("NOT kept").select(F.col("doc_id").alias("_gone")).distinct()
    return docs.join(gone, F.col("doc_id") == F.col("_gone"), "left_anti")
