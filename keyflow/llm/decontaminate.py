"""Benchmark decontamination by spaced seeds.

A mask picks some positions of a run of words and ignores the others, so a substituted word spoils only the seeds
that look at it. The masks of each length of item are chosen so that one seed at least is left whichever words are
substituted, as many as may be. Seeds of the benchmark and of the documents are joined by hash; a hit says at which offset an item
may lie in a document, and that alignment is then compared word by word. To keep the seeds of ordinary text out of
the shuffle, documents are first held against a bit map of the benchmark's seeds. It has a fixed size whatever the
benchmark's; a larger benchmark fills it up and only lets more seeds through to the join.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import alone, bit_map, identified, mapped, small_batches, texts_of, unpacked
from keyflow.llm.components import written

TOKEN = re.compile(r"\w+")
#: Scripts without spaces between words: Thai, Lao, Myanmar, Khmer, kana, Han.
UNSPACED = r"\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3005-\u3007\u3040-\u30ff\u31f0-\u31ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9f\U00020000-\U000323af"
HAS_UNSPACED = re.compile(f"[{UNSPACED}]")
UNSPACED_TOKEN = re.compile(rf"(?=\w)[{UNSPACED}]|[^\W{UNSPACED}]+")
#: Fixed masks, which words of a run count: those of each length of an item, the last for all longer ones.
LONG = ("111011011", "110110111", "111100111", "101111101")
MASKS = {
    1: ("1",),
    2: ("11",),
    3: ("111",),
    4: ("1111",),
    5: ("111", "1101"),
    6: ("1111", "11011"),
    7: ("11111", "110111", "111011"),
    8: ("111111", "1101111", "1111011"),
    9: (*LONG, "11111111"),
    10: (*LONG, "11111", "110111", "1101011"),
    11: (*LONG, "111111", "1101111", "1100101011"),
    12: (*LONG, "1111111", "11001010111"),
    13: (*LONG, "110010101111"),
}
#: Words that must be compared and the share of them that must agree; an item with fewer words is compared whole.
OVERLAP_WORDS = 13
OVERLAP_SHARE = 0.8
#: Words of neighbouring texts that are seeded at once.
GROUP_WORDS = 1 << 18
#: Fixed value, odd: a run's hash weighs its words by its powers.
FACTOR = 0xD6E8FEB86659FD93


def tokens(text: str | None) -> list[str]:
    """Words without punctuation, in lower case; single characters in scripts without spaces."""
    if not text:
        return []
    lower = text.lower()
    spaced = lower.isascii() or not HAS_UNSPACED.search(lower)
    return (TOKEN if spaced else UNSPACED_TOKEN).findall(lower)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(29))


def seeds(words: np.ndarray, mask: str, number: int) -> np.ndarray:
    """The hash of the run that begins at each word: the words' hashes by powers of an odd number, summed and mixed."""
    n = max(len(words) - len(mask) + 1, 0)
    total = np.full(n, number + 1, np.uint64)
    factor = np.uint64(1)
    for at, bit in enumerate(mask):
        if bit == "1":
            total += words[at : at + n] * factor if at else words[:n]
        factor = np.uint64(int(factor) * FACTOR % (1 << 64))
    return mixed(total)


def hashes_of(words: list[str]) -> np.ndarray:
    """The 64-bit hash of each word, computed once for all words that are the same."""
    coded = pa.array(words, pa.large_string()).dictionary_encode()
    names = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
    return np.fromiter(map(xxhash.xxh64_intdigest, names), np.uint64, len(names))[coded.indices.to_numpy()]


def seed_table(texts: DataFrame, key: str, masks: dict[int, tuple[str, ...]], used: list[int] | None = None, bits: bytes | None = None) -> DataFrame:
    """``seed, key, at, mask`` of all runs by the masks of the text's length; with ``used`` by the masks of these numbers
    whatever the length, and only of runs whose seed the map ``bits`` has."""
    numbers = {mask: number for number, mask in enumerate(sorted({mask for some in masks.values() for mask in some}))}
    by_length = {length: [(numbers[mask], mask) for mask in some] for length, some in masks.items()}
    numbered = [(number, mask) for mask, number in numbers.items()]
    of_docs = [(number, mask) for number, mask in numbered if used is not None and number in used]

    def seeded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("decontamination")
        known = unpacked(bits) if bits else None
        for batch in batches:
            for keys, texts in groups(batch):
                yield seeded_group(keys, texts, known)

    def groups(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[list[str]]]]:
        """Ids and words of texts, about ``GROUP_WORDS`` words at a time: a text of any length stays whole."""
        keys, texts, size = [], [], 0
        for key_of, text in zip(batch["key"].to_pylist(), batch["text"].to_pylist(), strict=True):
            if key_of is None or not (words := tokens(text)):
                continue
            keys.append(key_of)
            texts.append(words)
            size += len(words)
            if size >= GROUP_WORDS:
                yield keys, texts
                keys, texts, size = [], [], 0
        if keys:
            yield keys, texts

    def seeded_group(keys: list[int], texts: list[list[str]], known: np.ndarray | None) -> pa.RecordBatch:
        """All texts are seeded as one; a run that goes over the end of its text is none."""
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(lengths)
        hashed = hashes_of([*chain.from_iterable(texts)])
        key_of = np.array(keys, np.int64)
        found: list[tuple[np.ndarray, ...]] = []
        for number, mask in numbered if used is None else of_docs:
            one = seeds(hashed, mask, number)
            at = np.arange(len(one)) if known is None else mapped(known, one)
            row = np.searchsorted(ends, at, "right")
            whole = at + len(mask) <= ends[row]
            if used is None:
                whole &= np.array([(number, mask) in by_length[length] for length in np.minimum(lengths, max(by_length)).tolist()])[row]
            at, row = at[whole], row[whole]
            found.append((one[at].view(np.int64), key_of[row], (at - ends[row] + lengths[row]).astype(np.int32), np.full(len(at), number, np.int32)))
        columns = zip(*found, strict=True) if found else [()] * 4
        kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else [], kind) for x, kind in zip(columns, kinds, strict=True)], ["seed", "key", "at", "mask"])

    return texts.select(F.col(key).alias("key"), "text").mapInArrow(seeded, "seed long, key long, at int, mask int")


def overlap(doc: list[str], item: list[str], shift: int, words: int, share: float) -> tuple[int, int, int] | None:
    """First word, length and agreeing words of what the item at offset ``shift`` covers of the document."""
    begin, end = max(shift, 0), min(shift + len(item), len(doc))
    words = min(words, len(item))
    if end - begin < words:
        return None
    same = np.fromiter((a == b for a, b in zip(doc[begin:end], item[begin - shift : end - shift], strict=True)), np.int32, end - begin)
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(sums[words:] - sums[:-words] >= share * words)
    if not len(good):
        return None
    first, last = int(good[0]), int(good[-1]) + words
    return begin + first, last - first, int(sums[last] - sums[first])


def find(
    docs: DataFrame, benchmark: DataFrame, masks: dict[int, tuple[str, ...]] = MASKS, words: int = OVERLAP_WORDS, share: float = OVERLAP_SHARE
) -> DataFrame:
    """``doc_id, item_id, first_word, n_words, n_matched``: items that lie in documents, one row per pair.

    A pair is reported if at some offset a run of ``words`` words, or the whole of a shorter item, agrees in at least
    ``share`` of them; the row has the offset with most agreeing words, the first of several. Null or empty texts and rows
    without id match nothing. Repeated ids: a pair is reported once for all rows that share them. ``MASKS`` miss nothing
    at the usual ``words`` and ``share``. Documents are seeded only by masks that some item has.
    """
    small_batches(docs.sparkSession)
    docs = identified(docs)
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")).where("item_id IS NOT NULL")
    wanted = written(seed_table(items, "item_id", masks), "seeds")
    used = [row["mask"] for row in wanted.select("mask").distinct().collect()]
    bits = bit_map(wanted.select(F.col("seed").alias("hash")))
    hits = seed_table(docs, "doc_id", masks, used, bits).drop("mask").withColumnsRenamed({"key": "doc_id", "at": "_doc_at"})
    wanted = wanted.drop("mask").withColumnsRenamed({"key": "item_id", "at": "_item_at"})
    pairs = written(
        hits.join(wanted, "seed")
        .select("doc_id", "item_id", (F.col("_doc_at") - F.col("_item_at")).alias("_shift"))
        .groupBy("doc_id", "item_id")
        .agg(F.collect_set("_shift").alias("shifts")),
        "pairs",
    )

    def verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("decontamination")
        for batch in batches:
            out = []
            for doc_id, item_id, shifts, item, text in zip(*(batch[x].to_pylist() for x in ("doc_id", "item_id", "shifts", "item", "text")), strict=True):
                doc, wanted_words = tokens(text), tokens(item)
                found = [x for x in (overlap(doc, wanted_words, shift, words, share) for shift in shifts) if x]
                if found:
                    out.append((doc_id, item_id, *max(found, key=lambda x: (x[2], -x[0]))))
            columns = zip(*out, strict=True) if out else ((),) * 5
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, kinds, strict=True)], ["doc_id", "item_id", "first_word", "n_words", "n_matched"])

    texts = written(texts_of(docs, pairs), "texts")  # else both functions run in one stage, and a task takes two workers
    rows = pairs.join(items.withColumnRenamed("text", "item"), "item_id").join(texts, "doc_id").select("doc_id", "item_id", "shifts", "item", "text")
    found = rows.mapInArrow(verified, "doc_id long, item_id long, first_word int, n_words int, n_matched int")
    best = F.max(F.struct("n_matched", (-F.col("first_word")).alias("_before"), "n_words"))
    return found.groupBy("doc_id", "item_id").agg(best.alias("x")).select(
        "doc_id", "item_id", (-F.col("x._before")).alias("first_word"), "x.n_words", "x.n_matched"
    )


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, in which no item lies; rows without id stay."""
    found = find(docs, benchmark).select(F.col("doc_id").alias("_found")).distinct()
    return docs.join(found, F.col("doc_id") == F.col("_found"), "left_anti")
