"""What the operators share: table access, word rules, Arrow helpers."""

from __future__ import annotations

import gc
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: space and the controls 9 to 13.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
ASCII_LOWER = bytes(byte + 32 if 65 <= byte <= 90 else byte for byte in range(256))
#: Records handed to Python at once; a batch is text in memory, so it stays small.
BATCH_RECORDS = 512
CACHE_ENTRIES = 600_000
#: Bits of a map that keeps most rows out of a join; 1 MB.
FILTER_BITS = 1 << 23


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to a size whose texts fit a worker, unless the session asks for less."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(setting, "10000"))
    if now <= 0 or now > BATCH_RECORDS:
        spark.conf.set(setting, str(BATCH_RECORDS))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def identified(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads, under fixed names."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def fold_of(doc_id: Column, folds: int) -> Column:
    """Unsigned crc32 of the id as text, modulo the number of folds; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def lowered(text: str) -> str:
    """A to Z in lower case, all else as it is."""
    return text.lower() if text.isascii() else text.encode().translate(ASCII_LOWER).decode()


def list_array(parts: list[bytes], dtype: str = "<i4") -> pa.ListArray:
    """One list per part; each part holds packed numbers."""
    width = np.dtype(dtype).itemsize
    offsets = np.zeros(len(parts) + 1, np.int32)
    np.cumsum([len(part) // width for part in parts], out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.frombuffer(b"".join(parts), dtype)))


def slots(hashes: np.ndarray, bits: int = FILTER_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Two bits of a bit map for each 64-bit hash."""
    size = np.uint64(bits)
    return hashes % size, (hashes >> np.uint64(24)) % size


def bit_map(hashes: DataFrame, bits: int = FILTER_BITS) -> bytes:
    """A map of the hashes in column ``hash``, of a fixed size whatever their number. Words of 32 bits are combined in
    tasks, so at most one row for each word comes to the driver."""

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("filters")
        for batch in batches:
            both = np.concatenate(slots(batch["hash"].to_numpy(zero_copy_only=False).view(np.uint64), bits))
            values = np.int64(1) << (both % np.uint64(32)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array((both // np.uint64(32)).astype(np.int32)), pa.array(values)], ["word", "bits"])

    words = hashes.select("hash").mapInArrow(placed, "word int, bits long").groupBy("word").agg(F.expr("bit_or(bits)").alias("bits"))
    found = words.toArrow()
    out = np.zeros(bits // 32, np.uint32)
    out[found["word"].to_numpy()] = found["bits"].to_numpy().astype(np.uint32)
    return out.astype("<u4").tobytes()


def unpacked(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").astype(bool)


def mapped(known: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Rows whose hash may be in the map; all that are in it are found."""
    at = np.flatnonzero(known[hashes % np.uint64(len(known))])
    return at[known[slots(hashes[at], len(known))[1]]]


def texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows ``doc_id, text`` of ``docs`` whose id is in column ``doc_id`` of ``ids``.

    A bit map of the ids keeps most other texts out of the shuffle; more ids than it can tell apart only let
    more texts through to the join.
    """
    small_batches(docs.sparkSession)
    ids = ids.select("doc_id").distinct()
    bits = bit_map(ids.select(F.xxhash64("doc_id").alias("hash")))

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("filters")
        known = unpacked(bits)
        for batch in batches:
            at = mapped(known, batch["hash"].to_numpy(zero_copy_only=False).view(np.uint64))
            yield batch.select(["doc_id", "text"]).take(pa.array(at, pa.int64()))

    rows = docs.where("doc_id IS NOT NULL").select("doc_id", "text", F.xxhash64("doc_id").alias("hash"))
    return rows.mapInArrow(chosen, "doc_id long, text string").join(ids, "doc_id", "left_semi")


def runs(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of neighbouring rows with the same number in ``key``; the rows come sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        numbers = batch[key].to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(numbers[1:] != numbers[:-1]) + 1).tolist(), len(numbers)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            if held and held[0][key][0].as_py() != int(numbers[a]):
                yield pa.Table.from_batches(held)
                held = []
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


#: What a Python worker keeps from task to task: the tables and caches of one operator.
_kept: dict[str, dict[str, object]] = {}


def alone(operator: str) -> None:
    """Drops what other operators kept. Workers serve all operators of a session in turn, so every Arrow function of an
    operator begins with it, also of those that keep nothing: memory must not add up over the stages of a pipeline."""
    if operator not in _kept:
        _kept.clear()
        gc.collect()  # a cache that refers to its owner does not go by itself
        pa.default_memory_pool().release_unused()
        _kept[operator] = {}


def kept_by_worker(operator: str, key: str, make):
    """The object that a worker made under this key."""
    alone(operator)
    own = _kept[operator]
    if key not in own:
        own[key] = make()
    return own[key]


class Memo(dict):
    """A bounded cache: ``fill`` computes what is missing. When it is full, its entries become the older half, of
    which only those in use come back; what was not used meanwhile goes with the next change."""

    def __init__(self, fill, entries: int = CACHE_ENTRIES):
        super().__init__()
        self.fill, self.entries = fill, entries // 2
        self.older: dict = {}

    def __missing__(self, key):
        value = self.older.get(key)
        return self.keep(key, self.fill(key) if value is None else value)

    def keep(self, key, value):
        if len(self) >= self.entries:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value

    def recall(self, key):
        """The value if it is still there, else None."""
        value = self.get(key)
        if value is None and (value := self.older.get(key)) is not None:
            self.keep(key, value)
        return value
