"""Repeated strings removed with a distributed, common-prefix-aware merge of sorted suffixes.

A byte goes if it lies in a string of 100 bytes that also starts earlier in the corpus. Sorting the suffix at every byte would move
many times the corpus, so suffixes are taken at anchors: the anchor of a window of 100 bytes is where the least hash of
its 32-byte strings begins, so equal windows have the same anchor at the same place, and one anchor serves the
neighbouring windows that chose it. Its suffix reaches to the end of the last of these windows, and what stands
before it back to the start of the first.

1. Texts are dealt out once, into blocks by id. Hashes at anchors are counted over all blocks; a suffix whose first 32 bytes
   are nowhere else is known to be unique and is not sorted further.
2. Each block sorts the other suffixes into runs. Equal ones with the same context stay behind with their first place: all
   but the first are repeats. Runs are exchanged front-coded: what a suffix shares with the one before is a number.
3. A loser tree merges the runs. A loser keeps the length of its common prefix with the last winner, so two suffixes are
   compared by these numbers, and by characters only from where both have the same. The merge gives the common
   prefix of neighbours, which says which windows of a suffix can have an equal at all; these are settled in place.
4. A suffix start with very many occurrences is dealt out to several merges. What is first in one of these is then settled by the
   whole window, one row per window and merge.

Blocks and buckets have a share of the corpus each; none holds all occurrences of a string.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from keyflow.llm.common import alone, partitions, small_batches

WINDOW = 100
GRAM = 32
#: Blocks per shuffle partition: a block is held in memory.
BLOCKS = 4
#: Occurrences of one suffix start that one merge gets.
GROUP_ROWS = 20_000
#: Windows looked at at once in a long text; positions in a piece fit the low bits of a key.
PIECE = 1 << 22
PLACE = np.uint64((1 << 24) - 1)


def anchors(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Anchor positions, the first and last window start of each, and the hash of the 32 bytes there."""
    found = [piece_anchors(data[at : at + PIECE + WINDOW - 1], at) for at in range(0, max(len(data) - WINDOW + 1, 0), PIECE)]
    if not found:
        return (np.empty(0, np.int64),) * 3 + (np.empty(0, np.uint64),)
    return found[0] if len(found) == 1 else tuple(map(np.concatenate, zip(*found, strict=True)))


def piece_anchors(data: bytes, offset: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    hashes, width, factor = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1), 1, 0x9E3779B97F4A7C15
    while width < GRAM:
        hashes = hashes[:-width] * np.uint64(factor) + hashes[width:]
        width, factor = 2 * width, factor * factor % (1 << 64)
    hashes ^= hashes >> np.uint64(31)
    hashes *= np.uint64(0xBF58476D1CE4E5B9)
    hashes ^= hashes >> np.uint64(29)
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width, wanted = 1, WINDOW - GRAM + 1
    while 2 * width <= wanted:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if wanted > width:
        least = np.minimum(least[: len(least) - (wanted - width)], least[wanted - width :])
    at = (least & PLACE).astype(np.int64)
    first = np.concatenate([[0], np.flatnonzero(at[1:] != at[:-1]) + 1])
    last = np.concatenate([first[1:] - 1, [len(at) - 1]])
    at = at[first]
    return at + offset, first + offset, last + offset, hashes[at]


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix, of which ``known`` bytes need not be read."""
    size = min(len(a), len(b)) - known
    differ = int.from_bytes(a[known : known + size]) ^ int.from_bytes(b[known : known + size])
    return known + size - (differ.bit_length() + 7) // 8


class LoserTree:
    """Merges sorted runs of (suffix, common prefix with the one before, payload)."""

    def __init__(self, runs: list[Iterator[tuple[bytes, int, tuple]]]):
        self.runs = runs
        self.size = 1
        while self.size < len(runs):
            self.size *= 2
        self.heads: list[tuple[bytes, int, tuple] | None] = [next(run, None) for run in runs] + [None] * (self.size - len(runs))
        #: Common prefix of each head with the last suffix that was given out.
        self.shared = [0] * self.size
        self.losers = [-1] * self.size

    def play(self, a: int, b: int) -> tuple[int, int]:
        """Winner and loser of two runs; the loser's common prefix becomes that with the winner."""
        if self.heads[a] is None:
            return b, a
        if self.heads[b] is None:
            return a, b
        if self.shared[a] != self.shared[b]:
            return (a, b) if self.shared[a] > self.shared[b] else (b, a)
        first, second = self.heads[a][0], self.heads[b][0]
        prefix = common_prefix(first, second, self.shared[a])
        if prefix == len(second) and len(second) < len(first) or prefix < min(len(first), len(second)) and second[prefix] < first[prefix]:
            self.shared[a] = prefix
            return b, a
        self.shared[b] = prefix
        return a, b

    def build(self, node: int) -> int:
        if node >= self.size:
            return node - self.size
        winner, self.losers[node] = self.play(self.build(2 * node), self.build(2 * node + 1))
        return winner

    def __iter__(self) -> Iterator[tuple[bytes, int, tuple]]:
        """Suffixes in order, each with its common prefix with the one before."""
        winner = self.build(1) if self.size > 1 else 0
        while (head := self.heads[winner]) is not None:
            yield head[0], self.shared[winner], head[2]
            after = self.heads[winner] = next(self.runs[winner], None)
            if after is not None:
                self.shared[winner] = after[1]
            node = (winner + self.size) // 2
            while node:
                winner, self.losers[node] = self.play(winner, self.losers[node])
                node //= 2


def coded(entries: list[tuple[bytes, bytes, int, int, int]]) -> list[bytes]:
    """A sorted run, front-coded: common prefixes, rests, contexts, places."""
    prefixes, rests, before = [], [], b""
    for suffix, *_ in entries:
        shared = common_prefix(before, suffix, 0)
        prefixes.append(shared)
        rests.append(suffix[shared:])
        before = suffix
    lefts = [entry[1] for entry in entries]
    sizes = np.array([prefixes, [*map(len, rests)], [*map(len, lefts)]], np.uint8)
    places = np.array([entry[2:] for entry in entries], np.int64)
    return [sizes.tobytes(), b"".join(rests), b"".join(lefts), places.tobytes()]


def decoded(block: int, sizes: bytes, rests: bytes, lefts: bytes, places: bytes) -> Iterator[tuple[bytes, int, tuple]]:
    prefixes, rest_sizes, left_sizes = np.frombuffer(sizes, np.uint8).reshape(3, -1).tolist()
    suffix, rest_at, left_at = b"", 0, 0
    for shared, rest, left, place in zip(prefixes, rest_sizes, left_sizes, np.frombuffer(places, np.int64).reshape(-1, 3).tolist(), strict=True):
        suffix = suffix[:shared] + rests[rest_at : rest_at + rest]
        yield suffix, shared, (lefts[left_at : left_at + left], *place, block)
        rest_at, left_at = rest_at + rest, left_at + left


class Spans:
    """Removed stretches by block: (row key, row number, begin, end) as packed numbers."""

    def __init__(self):
        self.by_block: dict[int, list[tuple[int, int, int, int]]] = {}

    def add(self, block: int, *span: int) -> None:
        self.by_block.setdefault(block, []).append(span)

    def rows(self) -> tuple[list[int], list[bytes]]:
        return [*self.by_block], [np.array(spans, np.int64).tobytes() for spans in self.by_block.values()]


RUN = ["sizes", "rests", "lefts", "places"]
RUN_SCHEMA = pa.schema([("bucket", pa.int64()), ("salt", pa.int32()), ("block", pa.int64()), *((x, pa.binary()) for x in RUN), ("spans", pa.binary())])
MERGED_SCHEMA = pa.schema([("route", pa.int64()), ("block", pa.int64()), ("spans", pa.binary()), ("windows", pa.binary()), ("places", pa.binary())])


def ordered(block: pa.Table) -> tuple[pa.Table, list[bytes], list[int], list[int]]:
    """The rows of a block in order of key and text, with texts as bytes, keys, and numbers of rows with the same key."""
    texts = [text or b"" for text in block["text"].cast(pa.binary()).to_pylist()]
    keys = block["_key"].to_pylist()
    order = sorted(range(len(keys)), key=lambda row: (keys[row], texts[row]))
    keys, texts, numbers = [keys[row] for row in order], [texts[row] for row in order], []
    for at, key in enumerate(keys):
        numbers.append(numbers[-1] + 1 if at and keys[at - 1] == key else 0)
    return block.take(pa.array(order, pa.int64())), texts, keys, numbers


def hashes_of(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Per block and bucket: the distinct hashes at anchors and how often they occur."""
    found: dict[int, list[np.ndarray]] = {}
    for batch in batches:
        for block, text in zip(batch["_block"].to_pylist(), batch["text"].cast(pa.binary()).to_pylist(), strict=True):
            if text and len(text) >= WINDOW:
                found.setdefault(block, []).append(anchors(text)[3])
    for block, parts in found.items():
        hashes, counts = np.unique(np.concatenate(parts), return_counts=True)
        bucket = ((hashes >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        hashes, counts, bucket = hashes[order], counts[order].astype(np.uint32), bucket[order]
        cuts = [0, *(np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist(), len(bucket)]
        pairs = [*zip(cuts[:-1], cuts[1:], strict=True)]
        columns = [
            pa.array([int(bucket[a]) for a, _ in pairs], pa.int64()),
            pa.array([block] * len(pairs), pa.int64()),
            pa.array([hashes[a:b].tobytes() for a, b in pairs], pa.binary()),
            pa.array([counts[a:b].tobytes() for a, b in pairs], pa.binary()),
        ]
        yield pa.RecordBatch.from_arrays(columns, ["bucket", "block", "hashes", "counts"])


def repeated_of(table: pa.Table) -> pa.Table:
    """Per block: its hashes that occur more than once in all blocks, with the number of occurrences."""
    parts = [np.frombuffer(x, np.uint64) for x in table["hashes"].to_pylist()]
    counts = np.concatenate([np.frombuffer(x, np.uint32) for x in table["counts"].to_pylist()]).astype(np.int64)
    known, at = np.unique(np.concatenate(parts), return_inverse=True)
    totals = np.bincount(at, counts, len(known)).astype(np.int64)[at]
    blocks, hashes, loads, begin = [], [], [], 0
    for block, part in zip(table["block"].to_pylist(), parts, strict=True):
        total = totals[begin : begin + len(part)]
        begin += len(part)
        if (total > 1).any():
            blocks.append(block)
            hashes.append(part[total > 1].tobytes())
            loads.append(total[total > 1].tobytes())
    return pa.table({"block": pa.array(blocks, pa.int64()), "hashes": pa.array(hashes, pa.binary()), "loads": pa.array(loads, pa.binary())})


def runs_of(block: pa.Table, repeated: pa.Table, buckets: int, group_rows: int) -> pa.Table:
    """The sorted runs of a block, and what repeats within it."""
    out: list[tuple] = []
    if block.num_rows and repeated.num_rows:
        hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in repeated["hashes"].to_pylist()])
        loads = np.concatenate([np.frombuffer(x, np.int64) for x in repeated["loads"].to_pylist()])
        order = np.argsort(hashes)
        hashes, loads = hashes[order], loads[order]
        number = block["_block"][0].as_py()
        _, texts, keys, numbers = ordered(block)
        spans, seen, runs = Spans(), set(), {}
        for text, key, row in zip(texts, keys, numbers, strict=True):
            at, first, last, values = anchors(text)
            place = np.minimum(np.searchsorted(hashes, values), len(hashes) - 1)
            kept = np.flatnonzero(hashes[place] == values)
            load, value = loads[place[kept]], values[kept]
            salts = -(-load // group_rows)
            bucket = np.where(salts > 1, value.view(np.int64), ((value >> np.uint64(32)) % np.uint64(buckets)).astype(np.int64))
            salt = np.where(salts > 1, number % salts, -1)
            for a, begin, end, to in zip(at[kept].tolist(), first[kept].tolist(), (last[kept] + WINDOW).tolist(), zip(bucket.tolist(), salt.tolist(), strict=True), strict=True):
                suffix, left = text[a:end], text[begin:a]
                if (suffix, left) in seen:
                    spans.add(number, key, row, begin, end)
                else:
                    seen.add((suffix, left))
                    runs.setdefault(to, []).append((suffix, left, key, row, a))
        for (bucket, salt), entries in runs.items():
            entries.sort()
            out.append((bucket, salt, number, *coded(entries), None))
        out += [(number % buckets, -1, number, *(b"",) * 4, packed) for packed in spans.rows()[1]]
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [()] * len(RUN_SCHEMA), RUN_SCHEMA, strict=True)], schema=RUN_SCHEMA)


class Settled:
    """Settles the windows of suffixes that share their first bytes."""

    def __init__(self, salted: bool):
        self.salted = salted
        self.spans = Spans()
        self.windows: list[bytes] = []
        self.places: list[tuple[int, int, int, int]] = []

    def group(self, members: list[tuple[bytes, int, tuple]]) -> None:
        """``members``: suffix, common prefix with the one before, (left context, row key, row number, position, block).

        A window of a suffix that reaches further than the common prefix with both neighbours has no equal here.
        """
        if len(members) == 1 and not self.salted:
            return
        first: dict[bytes, tuple[int, int, int]] = {}
        tried: list[tuple[tuple, range, bytes]] = []
        for at, (suffix, shared, place) in enumerate(members):
            left, key, row, position, _ = place
            shared = max(shared if at else 0, members[at + 1][1] if at + 1 < len(members) else 0)
            reach = len(suffix) if self.salted else shared
            offsets = range(max(WINDOW - len(suffix), WINDOW - reach), len(left) + 1)
            if not offsets:
                continue
            whole, here = left + suffix, (key, row, position)
            tried.append((place, offsets, whole))
            for offset in offsets:
                start = len(left) - offset
                window = whole[start : start + WINDOW]
                best = first.get(window)
                if best is None or here < best:
                    first[window] = here
        for (left, key, row, position, block), offsets, whole in tried:
            least = most = -1
            for offset in offsets:
                start = len(left) - offset
                window = whole[start : start + WINDOW]
                if first[window] != (key, row, position):
                    least, most = offset if least < 0 else least, offset
                elif self.salted:
                    self.windows.append(xxhash.xxh3_128_digest(window))
                    self.places.append((key, row, position - offset, block))
            if least >= 0:
                self.spans.add(block, key, row, position - most, position - least + WINDOW)


def merge(table: pa.Table, buckets: int) -> pa.Table:
    """Merges the runs of a bucket and settles its windows; spans of blocks pass through."""
    out = []
    rows = [*zip(*(table[x].to_pylist() for x in ("block", *RUN, "spans")), strict=True)]
    salted = bool(rows) and table["salt"][0].as_py() >= 0
    settled, members = Settled(salted), []
    runs = [decoded(*row[:5]) for row in rows if row[5] is None]
    for suffix, shared, place in LoserTree(runs) if runs else ():
        if members and shared < GRAM:
            settled.group(members)
            members = []
        members.append((suffix, shared, place))
    if members:
        settled.group(members)
    out += [(block % buckets, block, packed, None, None) for block, *_, packed in rows if packed is not None]
    out += [(block % buckets, block, packed, None, None) for block, packed in zip(*settled.spans.rows(), strict=True)]
    routes: dict[int, list[int]] = {}
    for at, window in enumerate(settled.windows):
        routes.setdefault(int.from_bytes(window[:6]) % buckets, []).append(at)
    for route, rows_at in routes.items():
        places = np.array([settled.places[at] for at in rows_at], np.int64)
        out.append((route, -1, None, b"".join(settled.windows[at] for at in rows_at), places.tobytes()))
    return pa.Table.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out, strict=True) if out else [()] * len(MERGED_SCHEMA), MERGED_SCHEMA, strict=True)], schema=MERGED_SCHEMA)


def settle(table: pa.Table) -> pa.Table:
    """Settles windows that are first in several merges; spans pass through."""
    blocks, packed = [], []
    first: dict[bytes, tuple] = {}
    spans = Spans()
    for block, span, windows, places in zip(*(table[x].to_pylist() for x in ("block", "spans", "windows", "places")), strict=True):
        if span is not None:
            blocks.append(block)
            packed.append(span)
            continue
        for at, place in enumerate(map(tuple, np.frombuffer(places, np.int64).reshape(-1, 4).tolist())):
            window = windows[16 * at : 16 * at + 16]
            best = first.setdefault(window, place)
            if best[:3] != place[:3]:
                key, row, begin, owner = max(best, place)
                spans.add(owner, key, row, begin, begin + WINDOW)
                first[window] = min(best, place)
    more, rows = spans.rows()
    return pa.table({"block": pa.array(blocks + more, pa.int64()), "spans": pa.array(packed + rows, pa.binary())})


def cut(block: pa.Table, spans: pa.Table, names: list[str], as_text: bool) -> pa.Table:
    """The rows of a block with the covered bytes taken out."""
    table, texts, keys, numbers = ordered(block)
    marks: dict[tuple[int, int], list[tuple[int, int]]] = {}
    for packed in spans["spans"].to_pylist() if spans.num_rows else ():
        for key, row, begin, end in np.frombuffer(packed, np.int64).reshape(-1, 4).tolist():
            marks.setdefault((key, row), []).append((begin, end))
    removed, stretches, kept = [], [], []
    for text, key, row in zip(texts, keys, numbers, strict=True):
        parts, at, gone, count, open_to = [], 0, 0, 0, -1
        for begin, end in sorted(marks.get((key, row), ())):
            if begin > open_to:
                parts.append(text[at:begin])
                count += 1
                open_to = begin
            gone += max(0, end - open_to)
            at = open_to = max(open_to, end)
        parts.append(text[at:])
        removed.append(gone)
        stretches.append(count)
        kept.append(b"".join(parts))
    table = table.drop_columns(["_block", "_key"])
    rest = pa.array([x.decode("utf-8", "ignore") for x in kept], pa.string()) if as_text else pa.array(kept, pa.binary())
    new = [pa.array([*map(len, texts)], pa.int64()), pa.array(removed, pa.int64()), pa.array(stretches, pa.int64()), rest]
    return pa.Table.from_arrays([*table.columns, *new], names=names)


ADDED = {"n_bytes": "bigint", "n_removed": "bigint", "n_spans": "bigint", "kept": "binary"}


def remove(docs: DataFrame, group_rows: int = GROUP_ROWS, as_text: bool = False) -> DataFrame:
    """The columns of ``docs`` (``doc_id`` a whole number, ``text``) with ``n_bytes, n_removed, n_spans, kept``; columns
    of these names are replaced. ``kept``: the bytes that remain, which may begin or end within a character; with
    ``as_text`` the text of these bytes without characters that were cut in part.

    A null text is empty; texts of fewer than 100 bytes neither lose nor cause anything. Earlier is: smaller ``doc_id``, then
    earlier start. Rows with a null id come before all others, in an order given by a hash of their text; rows that share an
    id are documents of their own, in order of their texts.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = partitions(spark)
    key = F.when(F.col("doc_id").isNull(), F.lit(-(1 << 63)) + F.shiftrightunsigned(F.xxhash64("text"), 2)).otherwise(F.col("doc_id").cast("long"))
    docs = docs.drop(*ADDED, "_key", "_block").withColumn("_key", key)
    blocks = docs.withColumn("_block", F.pmod(F.xxhash64("_key"), F.lit(BLOCKS * buckets))).repartition(buckets, "_block")
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.drop("_key").schema)
    added = ADDED | ({"kept": "string"} if as_text else {})
    schema = f"{columns}, " + ", ".join(f"{name} {kind}" for name, kind in added.items())
    names = [*docs.drop("_key").columns, *added]
    empty = to_arrow_schema(spark.createDataFrame([], schema).schema).empty_table()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("repeats")
        return hashes_of(batches, buckets)

    def sorted_runs(key: tuple, block: pa.Table, repeated: pa.Table) -> pa.Table:
        alone("repeats")
        return runs_of(block, repeated, buckets, group_rows)

    def merged(key: tuple, table: pa.Table) -> pa.Table:
        alone("repeats")
        return merge(table, buckets)

    def cut_out(key: tuple, block: pa.Table, spans: pa.Table) -> pa.Table:
        alone("repeats")
        return cut(block, spans, names, as_text) if block.num_rows else empty

    hashes = blocks.mapInArrow(hashed, "bucket long, block long, hashes binary, counts binary")
    repeated = hashes.groupBy("bucket").applyInArrow(lambda table: repeated_of(table), "block long, hashes binary, loads binary")
    run_columns = "bucket long, salt int, block long, sizes binary, rests binary, lefts binary, places binary, spans binary"
    runs = blocks.groupBy("_block").cogroup(repeated.groupBy("block")).applyInArrow(sorted_runs, run_columns)
    settled = (
        runs.groupBy("bucket", "salt")
        .applyInArrow(merged, "route long, block long, spans binary, windows binary, places binary")
        .groupBy("route")
        .applyInArrow(lambda table: settle(table), "block long, spans binary")
    )
    return blocks.groupBy("_block").cogroup(settled.groupBy("block")).applyInArrow(cut_out, schema)
