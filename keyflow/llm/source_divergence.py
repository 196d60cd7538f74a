"""Source divergence audit: how differently the sources of a language use its terms.

Which terms a language keeps is an iceberg query, refined by prefixes: a level counts for each byte prefix of that level the
documents that have it, and what falls below the threshold goes with all terms that extend it. Longer prefixes follow only
where the shorter one stayed, twice as long at each level, until all that is left are complete terms. As a document
is whole in one task, its distinct prefixes are counted there and the counts of tasks add up; no table of documents and terms is
shuffled. Kept prefixes go to the next level as a bit map of bounded size: a prefix that is in it by chance is
counted on in vain, and the exact count of complete terms drops it.

The kept terms' counts in each source give the shares. Sources are compared in tiles of a block of sources by a block
of sources, dealt by term over as many tasks as the counts need; a tile's sums over its terms add up.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from keyflow.llm.common import Memo, bit_map, small_batches, unpacked
from keyflow.llm.components import written

#: A term is a run of letters A to Z, in lower case, and bytes beyond ASCII; all other bytes of a text become spaces.
TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
LEAST_DOCS = 10
#: Bytes of the first level's prefixes; each level doubles them.
FIRST_BYTES = 8
TOP_TERMS = 10
#: Counters of a task are passed on when they have so many entries.
ENTRIES = 400_000
#: The bit map of kept prefixes has this many bits at most.
MOST_BITS = 1 << 26
#: Groups that may be broadcast; more are joined salted.
BROADCAST_GROUPS = 100_000
SALTS = 32
#: Sources of one side of a tile, counts of a tile that one task takes, and shares it holds at once.
TILE_SOURCES = 256
TILE_ROWS = 400_000
CELLS = 1 << 20


def terms_of(text: str) -> Counter:
    return Counter(text.encode().translate(TERM_BYTES).split())


def staged_terms(docs: DataFrame) -> DataFrame:
    """``lang, source, terms, counts``: the distinct terms of every document, between spaces, and their packed counts.

    Documents of a source lie together, in partitions of the advised size however large the source is, so that what tasks
    count for it is few rows.
    """

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [terms_of(text) for text in batch["text"].to_pylist()]
            terms = pa.array([b" ".join(x) for x in found], pa.binary())
            counts = pa.array([np.fromiter(x.values(), "<i4", len(x)).tobytes() for x in found], pa.binary())
            yield pa.RecordBatch.from_arrays([batch["lang"], batch["source"], terms, counts], ["lang", "source", "terms", "counts"])

    found = docs.mapInArrow(listed, "lang string, source string, terms binary, counts binary")
    return docs.sparkSession.sql("SELECT /*+ REBALANCE(lang, source) */ * FROM {found}", found=found)


def binaries(counters: Iterable[Counter]) -> pa.Array:
    return pa.array([key for found in counters for key in found], pa.binary())


def numbers(counters: Iterable[Counter]) -> pa.Array:
    return pa.array([n for found in counters for n in found.values()], pa.int64())


def key_hash(lang: str, prefix: bytes) -> int:
    return xxhash.xxh64_intdigest(lang.encode() + b"\x00" + prefix)


class Known:
    """Is a prefix in the map of kept ones? Answers are remembered by language."""

    def __init__(self, bits: bytes):
        self.bits = unpacked(bits)
        self.of: dict[str, Memo] = {}

    def __call__(self, lang: str) -> Memo:
        if lang not in self.of:
            self.of[lang] = Memo(lambda prefix: self.has(key_hash(lang, prefix)))
        return self.of[lang]

    def has(self, hashed: int) -> bool:
        size = len(self.bits)
        return bool(self.bits[hashed % size] and self.bits[(hashed >> 24) % size])


def prefixes(staged: DataFrame, size: int, before: int, kept: bytes | None) -> DataFrame:
    """``lang, prefix, complete, docs``: documents of each prefix of ``size`` bytes, or of the whole term if it is
    no longer, among the terms longer than ``before`` whose prefix of ``before`` bytes was kept."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = None if kept is None else Known(kept)
        docs: dict[str, tuple[Counter, Counter]] = {}
        for batch in batches:
            for lang, joined in zip(batch["lang"].to_pylist(), batch["terms"].to_pylist(), strict=True):
                terms = joined.split(b" ") if joined else []
                if known is not None:
                    stayed = known(lang)
                    terms = [term for term in terms if len(term) > before and stayed[term[:before]]]
                cut, whole = docs.setdefault(lang, (Counter(), Counter()))
                cut.update({term[:size] for term in terms if len(term) > size})
                whole.update([term for term in terms if len(term) <= size])
            if sum(len(x) for both in docs.values() for x in both) > ENTRIES:
                yield packed(docs)
                docs = {}
        yield packed(docs)

    def packed(docs: dict[str, tuple[Counter, Counter]]) -> pa.RecordBatch:
        parts = [(lang, bool(complete), found) for lang, both in docs.items() for complete, found in enumerate(both)]
        sizes = [len(found) for _, _, found in parts]
        keys = [pa.array(np.repeat(np.array([part[at] for part in parts], kind), sizes)) for at, kind in ((0, object), (1, bool))]
        arrays = [keys[0].cast(pa.string()), binaries(found for *_, found in parts), keys[1], numbers(found for *_, found in parts)]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "prefix", "complete", "docs"])

    rows = staged.select("lang", "terms").mapInArrow(counted, "lang string, prefix binary, complete boolean, docs bigint")
    return rows.groupBy("lang", "prefix", "complete").agg(F.sum("docs").alias("docs"))


def map_of(rows: DataFrame, n: int) -> bytes:
    """A bit map of the ``n`` rows' languages and prefixes."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = map(key_hash, batch["lang"].to_pylist(), batch["prefix"].to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(found, np.uint64, batch.num_rows).view(np.int64))], ["hash"])

    bits = min(MOST_BITS, max(1 << 16, 1 << (8 * n).bit_length()))
    return bit_map(rows.select("lang", "prefix").mapInArrow(hashed, "hash bigint"), bits)


def kept_terms(staged: DataFrame, least_docs: int = LEAST_DOCS, first_bytes: int = FIRST_BYTES) -> DataFrame:
    """``lang, prefix``: the terms in at least ``least_docs`` documents of their language, as bytes."""
    size, before, kept, found = first_bytes, 0, None, []
    while True:
        level = written(prefixes(staged, size, before, kept).where(F.col("docs") >= least_docs), "prefixes")
        found.append(level.where("complete").select("lang", "prefix"))
        longer = level.where("NOT complete")
        if not (n := longer.count()):
            break
        kept, before, size = map_of(longer, n), size, 2 * size
    terms = found[0]
    for more in found[1:]:
        terms = terms.unionByName(more)
    return terms


def counts_in(staged: DataFrame, terms: DataFrame) -> DataFrame:
    """``lang, source, term, n``: occurrences of the kept terms in each source that has them."""
    bits = map_of(terms, terms.count())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Known(bits)
        groups: dict[tuple[str, str], Counter] = {}
        for batch in batches:
            columns = [batch[name].to_pylist() for name in ("lang", "source", "terms", "counts")]
            for lang, source, joined, counts in zip(*columns, strict=True):
                stayed, own = known(lang), groups.setdefault((lang, source), Counter())
                found = joined.split(b" ") if joined else []
                for term, n in zip(found, np.frombuffer(counts, "<i4").tolist(), strict=True):
                    if stayed[term]:
                        own[term] += n
            if sum(map(len, groups.values())) > ENTRIES:
                yield packed(groups)
                groups = {}
        yield packed(groups)

    def packed(groups: dict[tuple[str, str], Counter]) -> pa.RecordBatch:
        sizes = [len(found) for found in groups.values()]
        keys = [pa.array(np.repeat(np.array([group[at] for group in groups], object), sizes)).cast(pa.string()) for at in (0, 1)]
        arrays = [*keys, binaries(groups.values()), numbers(groups.values())]
        return pa.RecordBatch.from_arrays(arrays, ["lang", "source", "prefix", "n"])

    rows = staged.mapInArrow(counted, "lang string, source string, prefix binary, n bigint")
    summed = rows.groupBy("lang", "source", "prefix").agg(F.sum("n").alias("n"))
    return summed.join(terms, ["lang", "prefix"], "left_semi").select("lang", "source", F.col("prefix").cast("string").alias("term"), "n")


def with_group(rows: DataFrame, groups: DataFrame, keys: list[str], few: bool, spread: str) -> DataFrame:
    """Rows with the columns of their group. Groups that are ``few`` are broadcast; of others each row has salts, as one
    group may hold a third of the rows."""
    if few:
        return rows.join(F.broadcast(groups), keys)
    salted = groups.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return rows.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)).cast("int")).join(salted, [*keys, "_salt"]).drop("_salt")


def share(count: Column, total: Column, terms: Column) -> Column:
    """One and the parts in 1,000,000,000 of the count's smoothed share, in whole numbers."""
    billion = F.lit(1_000_000_000).cast("decimal(20,0)")
    above, below = (count + 2).cast("decimal(18,0)"), (total + 2 * terms).cast("decimal(20,0)")
    return 1 + F.call_function("div", billion * above, below)


def distance(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), p + q)


def tile_sums(rows: pa.Table, tile_sources: int, cells: int) -> pa.RecordBatch:
    """Sums of a tile over one bucket of terms. Rows without term are the tile's sources with their share of an unused
    term; all others are the shares of used terms. Bucket 0 counts all terms as unused by both, and every bucket takes
    its own terms from that."""
    i, j, bucket = (rows[name][0].as_py() for name in ("i", "j", "bucket"))
    lang, terms = rows["lang"][0].as_py(), rows["terms"][0].as_py()
    number, p = rows["number"].to_numpy(), rows["p"].to_numpy()
    head = rows["term"].is_null().to_numpy(zero_copy_only=False)
    order = np.argsort(number[head])
    numbers, unused = number[head][order], p[head][order]
    code = rows["term"].combine_chunks().dictionary_encode()
    code = (code.combine_chunks() if isinstance(code, pa.ChunkedArray) else code).indices.fill_null(0).to_numpy()[~head].astype(np.int64)
    n_terms = int(code.max()) + 1 if len(code) else 0
    place = np.searchsorted(numbers, number[~head])
    used = p[~head]
    side_a, side_b = (np.flatnonzero(numbers // tile_sources == block) for block in (i, j))

    def distances(x: np.ndarray, y: np.ndarray) -> np.ndarray:
        return (x - y) ** 2 // np.maximum(x + y, 1)

    sums = distances(unused[side_a][:, None], unused[side_b][None, :]) * ((terms if bucket == 0 else 0) - n_terms)
    step = max(1, cells // max(1, len(numbers)))
    by_term = np.argsort(code, kind="stable")
    starts = np.searchsorted(code[by_term], np.arange(0, n_terms + step, step))
    for at, (begin, end) in enumerate(zip(starts[:-1], starts[1:], strict=True)):
        some = by_term[begin:end]
        shares = np.tile(unused, (min(step, n_terms - at * step), 1))
        shares[code[some] - at * step, place[some]] = used[some]
        other = shares[:, side_b]
        for row, a in enumerate(side_a):
            sums[row] += distances(shares[:, a, None], other).sum(axis=0)
    a, b = np.meshgrid(numbers[side_a], numbers[side_b], indexing="ij")
    wanted = a < b
    arrays = [pa.array([lang] * int(wanted.sum()), pa.string()), *(pa.array(x[wanted].astype(np.int64)) for x in (a, b, sums))]
    return pa.RecordBatch.from_arrays(arrays, ["lang", "a", "b", "value"])


def pair_values(shares: DataFrame, groups: DataFrame, rows: int) -> DataFrame:
    """``lang, a, b, value`` for each two sources of a language by number, the smaller first."""
    buckets, tile_sources, cells = max(1, math.ceil(rows / TILE_ROWS)), TILE_SOURCES, CELLS
    block = F.floor(F.col("number") / tile_sources).cast("int")
    columns = ["lang", "term", "number", "p", "terms", "blocks", "bucket"]
    used = shares.withColumn("bucket", F.pmod(F.xxhash64("term"), F.lit(buckets)).cast("int")).select(*columns)
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1)))
    unused = groups.select("lang", F.lit(None).cast("string").alias("term"), "number", F.col("unused").alias("p"), "terms", "blocks", every.alias("bucket"))
    dealt = used.unionByName(unused).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    tiled = dealt.withColumns({"i": F.least(block, "_other"), "j": F.greatest(block, "_other")})
    tiled = tiled.select("lang", "i", "j", "bucket", "term", "number", "p", "terms")

    def summed(rows: pa.Table) -> pa.Table:
        return pa.Table.from_batches([tile_sums(rows, tile_sources, cells)])

    parts = tiled.groupBy("lang", "i", "j", "bucket").applyInArrow(summed, "lang string, a bigint, b bigint, value bigint")
    return parts.groupBy("lang", "a", "b").agg(F.sum("value").alias("value"))


def audit(docs: DataFrame, least_docs: int = LEAST_DOCS, top_terms: int = TOP_TERMS, first_bytes: int = FIRST_BYTES) -> DataFrame:
    """``lang, source, part, item, value, rank``: the other sources and the distinctive terms of every source.

    Terms are runs of letters A to Z, lower-cased, and of characters beyond ASCII. A language keeps the terms that
    at least ``least_docs`` of its documents have; ``p`` is a kept term's smoothed share of a source's or the language's
    kept terms, and the divergence of two shares is ``(p - q)² / (p + q)``, all in whole numbers. Part ``pair``: every other
    source of the language with the sum over its kept terms (0 without any). Part ``term``: the ``top_terms`` terms that
    the source uses more than its language, by divergence. Ranks count from 1 by value, highest first, then by item.

    Null texts, languages and sources are empty ones; rows are documents, whatever their id, and repeated rows are
    documents of their own. A source without terms has pairs but no terms. Long texts are read whole. An empty table gives
    no rows; only the three columns are read.
    """
    small_batches(docs.sparkSession)
    docs = docs.select(*(F.coalesce(F.col(name).cast("string"), F.lit("")).alias(name) for name in ("text", "lang", "source")))
    staged = written(staged_terms(docs), "terms")
    terms = kept_terms(staged, least_docs, first_bytes)
    counts = written(counts_in(staged, terms), "counts")
    of_lang = terms.groupBy("lang").agg(F.count("*").alias("terms"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    lang_totals = totals.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    by_source = Window.partitionBy("lang").orderBy("source")
    groups = staged.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left").join(lang_totals, "lang", "left")
    groups = groups.select("lang", "source", *(F.coalesce(name, F.lit(0)).alias(name) for name in ("total", "terms", "lang_total")))
    groups = groups.withColumns({"number": F.row_number().over(by_source) - 1, "_n": F.count("*").over(Window.partitionBy("lang"))})
    unused = F.when(F.col("terms") > 0, share(F.lit(0), F.col("total"), F.col("terms"))).otherwise(F.lit(0).cast("bigint"))
    groups = written(groups.withColumns({"unused": unused, "blocks": F.ceil(F.col("_n") / TILE_SOURCES).cast("int")}).drop("_n"), "groups")
    few = groups.count() <= BROADCAST_GROUPS
    shares = with_group(counts, groups, ["lang", "source"], few, "term").withColumn("p", share(F.col("n"), F.col("total"), F.col("terms")))
    pairs = pair_values(shares, groups, counts.count())
    names = groups.select("lang", F.col("number").cast("bigint").alias("a"), "source")
    both = pairs.unionByName(pairs.select("lang", F.col("b").alias("a"), F.col("a").alias("b"), "value"))
    both = with_group(both, names, ["lang", "a"], few, "b")
    both = with_group(both, names.select("lang", F.col("a").alias("b"), F.col("source").alias("item")), ["lang", "b"], few, "a")
    by_value = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    pair = both.select("lang", "source", F.lit("pair").alias("part"), "item", "value", F.row_number().over(by_value).alias("rank"))
    lang_counts = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"))
    own = shares.join(lang_counts, ["lang", "term"]).withColumn("q", share(F.col("lang_n"), F.col("lang_total"), F.col("terms"))).where("p > q")
    own = own.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), distance(F.col("p"), F.col("q")).alias("value"))
    term = own.withColumn("rank", F.row_number().over(by_value)).where(F.col("rank") <= top_terms)
    return pair.unionByName(term)


SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS doc, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
  FROM documents),
words AS (
  SELECT doc, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT doc) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL),
sizes AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
groups AS (
  SELECT g.lang, g.source, coalesce(s.v, 0) AS v, coalesce(sum(c.n), 0) AS total
  FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN sizes s USING (lang) LEFT JOIN counts c USING (lang, source)
  GROUP BY g.lang, g.source, s.v),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total::HUGEINT + 2 * g.v) AS p
  FROM groups g JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
of_lang AS (
  SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (sum(c.n) + 2)::HUGEINT) //
         ((SELECT sum(t.total) FROM groups t WHERE t.lang = k.lang)::HUGEINT + 2 * any_value(s.v)) AS q
  FROM kept k JOIN counts c USING (lang, term) JOIN sizes s USING (lang) GROUP BY k.lang, k.term),
pair_sums AS (
  SELECT a.lang, a.source, b.source AS item, sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p))::BIGINT AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pair_sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (
  SELECT s.lang, s.source, 'term' AS part, s.term AS item, (((s.p - l.q) * (s.p - l.q)) // (s.p + l.q))::BIGINT AS value
  FROM shares s JOIN of_lang l USING (lang, term) WHERE s.n > 0 AND s.p > l.q)
SELECT lang, source, part, item, value,
       row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 10
"""
