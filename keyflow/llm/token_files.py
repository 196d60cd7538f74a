"""Token files: Parquet with list columns, written in id order and read back column by column.

Files hold ``doc_id, place, n_tokens, ids``; a file is one range of ids, in ascending order. ``place`` counts the
ids before a document within its file, so a file can be written without knowing the others. The ids are
dictionary-encoded (their 16 bits suffice), ``place`` and the counts are delta-encoded by format version 2, row
groups are held to a size, and page indexes let a reader skip pages by id. The place among all files
comes from a read of the counts alone.
"""

from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from keyflow.llm.bpe import byte_of_symbol
from keyflow.llm.common import CACHE_ENTRIES, identified, kept_by_worker, list_array, partitions, small_batches

END_ID = 1
ROW_GROUP_BYTES = 16 << 20
PAGE_BYTES = 256 << 10
#: Characters handed to the tokenizer at once.
CALL_CHARS = 60_000
#: Bytes of texts whose parts are gathered at once.
GROUP_BYTES = 16 << 20
#: Parts whose ids a worker keeps, and as many of those before.
KNOWN_ENTRIES = CACHE_ENTRIES // 2


#: Letters whose lower case is one letter of the same range, in composed form as they are.
LETTERS = string.ascii_letters + "".join(chr(code) for code in range(0xC0, 0x100) if chr(code).isalpha())
LATIN = re.compile(f"[{LETTERS}]+")
#: Marks that are tokens of their own after a letter, with nothing after them; names of special tokens begin with "<".
MARKS = string.punctuation.replace("<", "")
PLAIN = rf"\A[{LETTERS}]+[{re.escape(MARKS)}]*\z"
#: Their bytes in the symbols of byte-level vocabularies.
SYMBOL_OF = {byte: symbol for symbol, byte in byte_of_symbol().items()}
SYMBOLS = {code: "".join(SYMBOL_OF[byte] for byte in chr(code).encode()) for code in range(128, 256)}


class Pieces:
    """Ids of the parts of a text between spaces and line ends. These never join two tokens of a vocabulary that drops
    white space, so the ids of a text are those of its parts, and frequent parts are encoded once. A part's ids are
    also those of its lower case, and a full stop or comma after a letter is a token of its own. A part of Latin letters
    passes the library's normalization and splits whole, so it goes to the library's model at once."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_padding()
        self.tokenizer.no_truncation()
        self.model = self.tokenizer.model
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.marks = {mark: np.array(self.tokenizer.encode(mark, add_special_tokens=False).ids, "<i4").tobytes() for mark in ".,"}

    @staticmethod
    def reduced(part: str) -> tuple[str, str]:
        """A part with the same ids but for the mark that goes with it. Names of special tokens are left alone."""
        if not part.isascii():
            if part[-1:] in {".", ","} and LATIN.fullmatch(part, 0, len(part) - 1):
                return part[:-1].lower(), part[-1]
            return (part.lower() if LATIN.fullmatch(part) else part), ""
        if "<" in part:
            return part, ""
        if part[-1:] in {".", ","} and part[-2:-1].isalpha():
            return part[:-1].lower(), part[-1]
        return part.lower(), ""

    def learn(self, words: list[str], others: list[str]) -> None:
        """Makes the ids of parts known that are not; ``words`` are Latin letters in lower case."""
        known, older = self.known, self.older.get
        new: dict[str, None] = {}
        odd: dict[str, None] = {}
        waiting: list[tuple[str, str, str]] = []
        for word in words:
            ids = older(word)
            if ids is None:
                new[word] = None
            else:
                known[word] = ids
        for part in others:
            ids = older(part)
            if ids is not None:
                known[part] = ids
                continue
            base, mark = self.reduced(part)
            waiting.append((part, base, mark))
            if base not in known:
                ids = older(base)
                if ids is not None:
                    known[base] = ids
                else:
                    (new if (base.isalpha() if base.isascii() else LATIN.fullmatch(base)) else odd)[base] = None
        self.encode_words([*new])
        line: list[str] = []
        size = 0
        for base in odd:
            line.append(base)
            size += len(base) + 1
            if size > CALL_CHARS:
                self.encode_line(line)
                line, size = [], 0
        if line:
            self.encode_line(line)
        for part, base, mark in waiting:
            known[part] = known[base] + self.marks[mark] if mark else known[base]

    def encode_words(self, words: list[str]) -> None:
        """The library's model takes words one by one; their ids are packed together."""
        tokenize, ids, cuts = self.model.tokenize, [], [0]
        for word in words:
            ids += [token.id for token in tokenize(word if word.isascii() else word.translate(SYMBOLS))]
            cuts.append(4 * len(ids))
        packed = np.array(ids, "<i4").tobytes()
        self.known.update(zip(words, [packed[a:b] for a, b in pairwise(cuts)], strict=True))

    def encode_line(self, bases: list[str]) -> None:
        encoding = self.tokenizer.encode(" ".join(bases), add_special_tokens=False)
        ids = np.array(encoding.ids, "<i4")
        begins = np.fromiter((x[0] for x in encoding.offsets), np.int64, len(ids))
        starts = np.zeros(len(bases) + 1, np.int64)
        np.cumsum([len(base) + 1 for base in bases], out=starts[1:])
        cuts = (4 * np.searchsorted(begins, starts)).tolist()
        packed = ids.tobytes()
        self.known.update(zip(bases, [packed[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)], strict=True))

    def lists(self, texts: pa.Array, end: list[int]) -> pa.ListArray:
        """The ids of each text and ``end`` after them; a null text is an empty one. Texts are split and their parts numbered
        by Arrow, which also puts words in lower case and takes the marks after them off, so Python sees each word once a
        batch, with all its capitals and marks. The ids are gathered by these numbers."""
        split = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        parts = split.flatten().dictionary_encode()
        names = parts.dictionary
        plain = pc.match_substring_regex(names, PLAIN)
        coded = pc.if_else(plain, pc.utf8_lower(pc.utf8_rtrim(names, MARKS)), names).dictionary_encode()
        marks = pc.utf8_ltrim(names.filter(plain), LETTERS).dictionary_encode()
        plain, base_of = plain.to_numpy(zero_copy_only=False), coded.indices.to_numpy()
        is_word = np.zeros(len(coded.dictionary) + len(marks.dictionary), bool)
        is_word[base_of[plain]] = True
        found = self.ids_of([*coded.dictionary.to_pylist(), *marks.dictionary.to_pylist()], is_word.tolist())
        pairs = np.full((len(names) + 1, 2), len(found))
        pairs[:-1, 0], pairs[-1, 0] = base_of, len(found) + 1
        pairs[:-1, 1][plain] = marks.indices.to_numpy() + len(coded.dictionary)
        both = list_array([*found, b"", np.array(end, "<i4").tobytes()]).take(pa.array(pairs.ravel()))
        ids = pa.ListArray.from_arrays(pa.array(both.offsets.to_numpy()[::2]), both.values)
        ends = np.cumsum(pc.list_value_length(split).fill_null(0).to_numpy(zero_copy_only=False), dtype=np.int64)
        gathered = ids.take(pa.array(np.insert(parts.indices.to_numpy(), ends, len(names))))
        cuts = np.concatenate([[0], ends + np.arange(1, len(ends) + 1)])
        return pa.ListArray.from_arrays(pa.array(gathered.offsets.to_numpy()[cuts]), gathered.values)

    def ids_of(self, bases: list[str], is_word: list[bool]) -> list[bytes]:
        if len(self.known) > KNOWN_ENTRIES:
            self.older, self.known = self.known, {}
        found = [*map(self.known.get, bases)]
        missing = [at for at, ids in enumerate(found) if ids is None]
        self.learn([bases[at] for at in missing if is_word[at]], [bases[at] for at in missing if not is_word[at]])
        for at in missing:
            found[at] = self.known[bases[at]]
        return found

    def encode(self, texts: list[str | None]) -> list[bytes]:
        lists = self.lists(pa.array(texts, pa.string()), [])
        values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
        return [values[a:b].tobytes() for a, b in zip(offsets[:-1], offsets[1:], strict=True)]


def grouped(batches: Iterator[pa.RecordBatch], most: int = GROUP_BYTES) -> Iterator[pa.RecordBatch]:
    """Neighbouring batches as one, up to a size; a larger batch stays alone. The larger a batch, the more of its parts
    are the same."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if held and sum(x.nbytes for x in held) + batch.nbytes > most:
            yield pa.concat_batches(held)
            held = []
        held.append(batch)
    if held:
        yield pa.concat_batches(held)


def pieces(path: str) -> Pieces:
    return kept_by_worker("files", path, lambda: Pieces(path))


def write(docs: DataFrame, vocabulary: str, path: str, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Encodes whole texts and writes them in ascending id order, ``end_id`` after each.

    A null text is an empty one. Rows with a null id come first; rows with the same id stand next to each other in
    an order given by their texts. One shuffle deals the texts out by ranges of the id; a number that is unique to
    the row splits an id that many rows share.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine, place = pieces(vocabulary), 0
        for batch in grouped(batches):
            ids = machine.lists(batch["text"], [end_id])
            counts = np.diff(ids.offsets.to_numpy()).astype(np.int64)
            before = place + np.cumsum(counts) - counts
            place += int(counts.sum())
            arrays = [batch["doc_id"], pa.array(before), pa.array(counts), ids]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "place", "n_tokens", "ids"])

    (
        identified(docs, id_col, text_col)
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(partitions(spark), F.col("doc_id").asc_nulls_first(), "_row")
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), "_row")
        .select("doc_id", "text")
        .mapInArrow(encoded, "doc_id long, place long, n_tokens long, ids array<int>")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", "0")
        .option("compression", "zstd")
        .option("parquet.writer.version", "PARQUET_2_0")
        .option("parquet.enable.dictionary", "true")
        .option("parquet.enable.dictionary#place", "false")
        .option("parquet.block.size", str(ROW_GROUP_BYTES))
        .option("parquet.page.size", str(PAGE_BYTES))
        .option("parquet.page.write-checksum.enabled", "true")
        .parquet(path)
    )


def file_starts(spark: SparkSession, path: str) -> DataFrame:
    """Per file: the ids in all files before it. Reads the counts only; one row per file is ordered."""
    files = (
        spark.read.parquet(path)
        .select(F.col("_metadata.file_name").alias("file"), "n_tokens")
        .groupBy("file")
        .agg(F.sum("n_tokens").alias("in_file"))
    )
    number = F.regexp_extract("file", r"^part-(\d+)", 1).cast("long")
    earlier = W.orderBy(number, "file").rowsBetween(W.unboundedPreceding, -1)
    return files.select("file", F.coalesce(F.sum("in_file").over(earlier), F.lit(0)).alias("first"))


def read_metadata(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens`` without touching the ids."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "place", "n_tokens")
    return rows.join(file_starts(spark, path), "file").select("doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id, start, n_tokens, ids``; a filter on ``doc_id`` reaches row groups and pages."""
    rows = spark.read.parquet(path).select(F.col("_metadata.file_name").alias("file"), "doc_id", "place", "n_tokens", "ids")
    return rows.join(F.broadcast(file_starts(spark, path)), "file").select(
        "doc_id", (F.col("first") + F.col("place")).alias("start"), "n_tokens", "ids"
    )


def digests(tokens: DataFrame) -> DataFrame:
    """Counts and checksums of what a token table holds."""
    small_batches(tokens.sparkSession)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch["ids"]
            values, offsets = lists.values.to_numpy(zero_copy_only=False).astype("<u4"), lists.offsets.to_numpy()
            sums = [zlib.crc32(values[a:b]) for a, b in zip(offsets[:-1], offsets[1:], strict=True)]
            kept = [batch["doc_id"], batch["start"], pa.array(np.diff(offsets).astype(np.int64)), pa.array(sums, pa.int64())]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "ids").mapInArrow(summed, "doc_id long, start long, n_tokens long, ids_crc32 long")
