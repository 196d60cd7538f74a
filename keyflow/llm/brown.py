"""Language-model scores from a class-based bigram model, the classes found by exchange clustering.

A word's probability is that of its class after the class before, times that of the word in its class. Every word of the
training texts gets its class by the exchange algorithm: it goes to the class where the likelihood of the class bigrams is
highest, until none moves. Unseen words have a class of their own.

The vocabulary grows with the corpus, so its words are never in one place. Texts are dealt out once, into blocks by id; a
block counts its distinct words, the counts meet by word, and each block gets back the corpus counts and the numbers of its
own words. Its texts then become numbers, and their bigrams meet by word: a word's neighbours with counts, in parts of bounded size.

The most frequent words go first, one by one in the driver, while all others count by bands of about the same count. From then on
all words move at once: each part proposes classes for its words against the class bigrams, a table whose size is a parameter. Moves
that do not raise the likelihood together are taken back, and half of them are tried. Besides that table, the driver and the
workers see one byte for each word, its class.
"""

from __future__ import annotations

import heapq
import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import WORD, identified, lowered, partitions, small_batches
from keyflow.llm.components import written

#: Frequent words that are clustered first, chosen by their counts in all training texts, and the classes of all words.
FREQUENT = 600
CLASSES = 48
SWEEPS = 6
#: Count bands where all other words begin: band b holds counts from 2**(b-1) on; band 0 is for unseen words.
BANDS = 48
SMOOTHING = 0.1
#: Weight of the class frequencies against the counts after one class.
BACK_OFF = 20.0
#: What of the words seen once goes to unseen words.
UNSEEN_SHARE = 0.5
#: So often the moves of a sweep are halved until they raise the likelihood.
HALVINGS = 6
#: Numbers that stand for the end of a text and for an unseen word.
END, UNSEEN = 2**32 - 1, 2**32 - 2
#: Tokens of the training texts for each part of the bigrams; pairs that a task holds; what a row of a part has at most of pairs and words.
PART_TOKENS = 4_000_000
HELD_PAIRS = 2_000_000
ROW_PAIRS, ROW_WORDS = 25_000, 4096
#: Counts up to this one have their changes of the likelihood tabled.
TABLED = 8
LIST = ["block", "words", "counts", "numbers", "owned"]


def frequent_words(totals: DataFrame, frequent: int) -> DataFrame:
    """One row ``chosen``: the most frequent words of all training texts in a line, ties in order of the words. ``totals`` has each
    bucket's most frequent ones. It stays a part of the plan, so the texts are shuffled once for counting and encoding."""
    words = totals.where("top IS NOT NULL").select(F.explode(F.arrays_zip("top", "top_counts")).alias("w")).select("w.top", "w.top_counts")
    most = words.orderBy(F.desc("top_counts"), "top").limit(frequent)
    line = F.sort_array(F.collect_list(F.struct((-F.col("top_counts")).alias("n"), F.col("top").alias("word"))))
    return most.agg(F.array_join(line["word"], " ").alias("chosen"))


def words_of(text: str | None) -> list[str]:
    return WORD.findall(lowered(text)) if text else []


def counted(block: pa.Table, buckets: int) -> pa.Table:
    """Per bucket of the hash: the distinct words of a block and their counts in training texts."""
    seen: Counter = Counter()
    other: set[str] = set()
    for text, training in zip(block["text"].to_pylist(), block["training"].to_pylist(), strict=True):
        (seen if training else other).update(words_of(text))
    words = np.array([*seen, *(other - seen.keys())], object)
    counts = np.zeros(len(words), np.int64)
    counts[: len(seen)] = np.fromiter(seen.values(), np.int64, len(seen))
    of = bucket_of(words, buckets)
    order = np.argsort(of, kind="stable")
    words, counts, of = words[order], counts[order], of[order]
    begins = np.flatnonzero(np.r_[True, of[1:] != of[:-1]][: len(of)])
    spans = [*zip(begins.tolist(), [*begins[1:].tolist(), len(of)], strict=True)] if len(of) else []
    number = block["_block"][0].as_py()
    return pa.table(
        {
            "bucket": pa.array(of[begins], pa.int64()),
            "block": pa.array([number] * len(spans), pa.int64()),
            "words": pa.array([" ".join(words[a:b].tolist()) for a, b in spans], pa.string()),
            "counts": pa.array([counts[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def bucket_of(words: np.ndarray, buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(word.encode("utf-8", "replace")) for word in words.tolist()), np.int64, len(words)) % buckets


def top_words(table: pa.Table, frequent: int) -> pa.Table:
    """A bucket's ``frequent`` most frequent words: those of the corpus are among them."""
    total: Counter = Counter()
    for words, counts in zip(table["words"].to_pylist(), table["counts"].to_pylist(), strict=True):
        n = np.frombuffer(counts, np.int64)
        split = words.split(" ")
        for at in np.flatnonzero(n).tolist():
            total[split[at]] += int(n[at])
    known = ((-n, word.encode("utf-8", "replace"), word) for word, n in total.items())
    top = [(word, -n) for n, _, word in heapq.nsmallest(frequent, known)]
    return pa.table({"top": pa.array([[word for word, _ in top]], pa.list_(pa.string())), "top_counts": pa.array([[n for _, n in top]], pa.list_(pa.int64()))})


def totalled(table: pa.Table, frequent: int, buckets: int) -> pa.Table:
    """Corpus counts of a bucket's words, and their numbers in order of the counts, back to the blocks. A known word is owned
    by the first block that has it. The first ``frequent`` numbers of all are kept for the most frequent words."""
    total: dict[str, int] = {}
    owner: dict[str, int] = {}
    rows = [(block, words.split(" "), np.frombuffer(counts, np.int64)) for block, words, counts in zip(*(table[x].to_pylist() for x in LIST[:3]), strict=True)]
    for block, words, counts in rows:
        for word, n in zip(words, counts.tolist(), strict=True):
            total[word] = total.get(word, 0) + n
            owner.setdefault(word, block)
    out = [(block, words, [*map(total.__getitem__, words)]) for block, words, _ in rows]
    known = sorted(word for word, n in total.items() if n)
    order = np.argsort([-total[word] for word in known], kind="stable").tolist()
    bucket = table["bucket"][0].as_py() if table.num_rows else 0
    number = {known[place]: at * buckets + bucket for at, place in enumerate(order)}
    if len(known) * buckets >= UNSEEN - frequent:
        raise ValueError("too many words for numbers of 32 bits")
    return pa.table(
        {
            "block": pa.array([block for block, _, _ in out], pa.int64()),
            "words": table["words"].combine_chunks() if table.num_rows else pa.array([], pa.string()),
            "counts": pa.array([np.array(counts, np.int64).tobytes() for _, _, counts in out], pa.binary()),
            "numbers": pa.array([np.fromiter((number.get(word, UNSEEN) for word in words), "<u4", len(words)).tobytes() for _, words, _ in out], pa.binary()),
            "owned": pa.array([sum(1 for word, n in zip(words, counts, strict=True) if n and owner[word] == block) for block, words, counts in out], pa.int64()),
        }
    )


ENCODED = "doc_id long, held_out boolean, n_words long, n_known long, base double, rest double, symbols binary, owned long"
ENCODED_NAMES = [part.split()[0] for part in ENCODED.split(", ")]


def encoded(block: pa.Table, lists: pa.Table) -> pa.Table:
    """Texts as numbers of words, by the counts of the block's words and one row with the frequent words of the corpus, which have
    the first numbers.

    ``base``: sum of log10(c + 0.1) of the words; ``rest``: of log10(c) of known words."""
    chosen = next((line for line in lists["chosen"].to_pylist() if line), "")
    frequent = {word: at for at, word in enumerate(chosen.split(" "))} if chosen else {}
    at, owned, parts = {}, 0, [(np.zeros(0, np.int64), np.zeros(0, np.uint32))]
    for words, counts, numbers, mine in zip(*(lists[x].to_pylist() for x in LIST[1:]), strict=True) if lists.num_rows else ():
        if words is None:
            continue
        owned += mine
        n, number = np.frombuffer(counts, np.int64), np.frombuffer(numbers, "<u4")
        number = np.where(n > 0, number + np.uint32(len(frequent)), np.uint32(UNSEEN))
        split, before = words.split(" "), len(at)
        at.update(zip(split, range(before, before + len(split)), strict=True))
        for word in frequent.keys() & at.keys():
            if at[word] >= before and n[at[word] - before]:
                number[at[word] - before] = frequent[word]
        parts.append((n, number))
    n, number = (np.concatenate(x) for x in zip(*parts, strict=True))
    base, rest = np.log10(n + SMOOTHING), np.log10(np.maximum(n, 1))
    rows = []
    for doc_id, text, training in zip(*(block[x].to_pylist() for x in ("doc_id", "text", "training")), strict=True):
        words = words_of(text)
        places = np.fromiter(map(at.__getitem__, words), np.int64, len(words))
        sums = (float(base[places].sum()), float(rest[places].sum()))
        rows.append((doc_id, not training, len(words), int((n[places] > 0).sum()), *sums, number[places].astype("<u4").tobytes(), 0 if rows else owned))
    kinds = [pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.binary(), pa.int64()]
    return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True) if rows else [()] * len(kinds), kinds, strict=True)], names=ENCODED_NAMES)


KINDS = ("<u4", "<u4", "<i8")


def squeezed(heads: np.ndarray, others: np.ndarray, counts: np.ndarray) -> bytes:
    """Numbers, and others with their counts, byte by byte of their places: most are small."""
    sizes = np.array([len(heads), len(others)], "<u4").tobytes()
    planes = (x.astype(kind).view(np.uint8).reshape(len(x), -1).T.tobytes() for x, kind in zip((heads, others, counts), KINDS, strict=True) if len(x))
    return sizes + pa.compress(b"".join(planes), "zstd", asbytes=True)


def loosened(data: bytes) -> list[np.ndarray]:
    heads, others = np.frombuffer(data, "<u4", 2).tolist()
    sizes = [(heads, 4), (others, 4), (others, 8)]
    planes, at, out = np.frombuffer(pa.decompress(data[8:], sum(n * width for n, width in sizes), "zstd", asbytes=True), np.uint8), 0, []
    for (n, width), kind in zip(sizes, KINDS, strict=True):
        out.append(np.ascontiguousarray(planes[at : at + n * width].reshape(width, n).T).view(kind).ravel().astype(np.int64))
        at += n * width
    return out


def neighbours(texts: DataFrame, parts: int) -> DataFrame:
    """The bigrams of the training texts by word: ``part, first, after, before, starts``. Word ``number`` is in part ``number`` modulo
    ``parts``, and a row has neighbouring ones of a part from the word at ``first`` on: how many words follow each, which, how
    often; the same of words before; and how often it starts a text."""

    def dealt(pairs: list[np.ndarray]) -> pa.RecordBatch:
        both, n = np.unique(np.concatenate(pairs), return_counts=True)
        left, right = (both >> np.uint64(32)).astype(np.int64), (both & np.uint64(END)).astype(np.int64)
        rows = []
        for side, (owner, other) in enumerate(((left, right), (right, left))):
            at = np.flatnonzero(owner != END)
            if side:
                at = at[np.argsort(owner[at], kind="stable")]
            at = at[np.argsort(owner[at] % parts, kind="stable")]
            cuts = np.searchsorted(owner[at] % parts, np.arange(parts + 1))
            for part in np.flatnonzero(np.diff(cuts)).tolist():
                own = at[cuts[part] : cuts[part + 1]]
                rows.append((part, side, squeezed(np.diff(owner[own] // parts, prepend=0), other[own], n[own])))
        columns = zip(*rows, strict=True) if rows else ((), (), ())
        return pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(columns, (pa.int64(), pa.int64(), pa.binary()), strict=True)], ["part", "side", "pairs"])

    def paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, end = [], np.array([END], "<u4")
        for batch in batches:
            texts = [np.frombuffer(x, "<u4") for x in batch["symbols"].to_pylist()]
            line = np.concatenate([end, *(x for text in texts for x in (text, end))]).astype(np.uint64)
            held.append((line[:-1] << np.uint64(32)) | line[1:])
            if sum(map(len, held)) >= HELD_PAIRS:
                yield dealt(held)
                held = []
        if held:
            yield dealt(held)

    def met(table: pa.Table) -> pa.Table:
        part, sides = table["part"][0].as_py(), []
        for side in (0, 1):
            lists = [loosened(x) for x, of in zip(table["pairs"].to_pylist(), table["side"].to_pylist(), strict=True) if of == side]
            word, other, n = (np.concatenate(x) for x in zip(*((np.cumsum(heads), other, n) for heads, other, n in lists), strict=True))
            order = np.lexsort((other, word))
            word, other, n = word[order], other[order], n[order]
            begins = np.flatnonzero(np.r_[True, (word[1:] != word[:-1]) | (other[1:] != other[:-1])])
            sides.append((word[begins], other[begins], np.add.reduceat(n, begins)))
        words = max(int(word[-1]) for word, _, _ in sides) + 1
        cuts = [np.searchsorted(word, np.arange(words + 1)) for word, _, _ in sides]
        pairs, first, rows = cuts[0] + cuts[1], 0, []
        while first < words:
            last = int(np.searchsorted(pairs, pairs[first] + ROW_PAIRS, "right")) - 1
            last = max(first + 1, min(last, first + ROW_WORDS, words))
            packed = []
            for (_, other, n), cut in zip(sides, cuts, strict=True):
                own = slice(cut[first], cut[last])
                packed.append(squeezed(np.diff(cut[first : last + 1]), other[own], n[own]))
            word, other, n = (x[own] for x in sides[1])
            at = np.flatnonzero(other == END)
            rows.append((part, first, *packed, squeezed(np.zeros(0), word[at] - first, n[at])))
            first = last
        return pa.Table.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), *[pa.binary()] * 3), strict=True)], names=["part", "first", "after", "before", "starts"])

    found = texts.where("NOT held_out AND n_words > 0").select("symbols").mapInArrow(paired, "part long, side long, pairs binary")
    return written(found.groupBy("part").applyInArrow(met, "part long, first long, after binary, before binary, starts binary"), "bigrams")


def places_of(part: int, first: int, words: int, parts: int) -> np.ndarray:
    return part + parts * (first + np.arange(words))


def of_words(rows: DataFrame, parts: int, last: int) -> np.ndarray:
    """Values of words by number, from rows ``part, first, values`` of bytes, and ``last`` for the end of a text."""
    found = rows.toArrow().to_pylist()
    lists = [(row["part"], row["first"], np.frombuffer(row["values"], np.uint16)) for row in found]
    size = max((part + parts * (first + len(values) - 1) + 1 for part, first, values in lists), default=0)
    out = np.zeros(size + 1, np.uint16)
    for part, first, values in lists:
        out[places_of(part, first, len(values), parts)] = values
    out[-1] = last
    return out.astype(np.uint8) if out.max() < 256 else out


def bands(pairs: DataFrame, parts: int) -> np.ndarray:
    """The count band of every word by number."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = []
            for after in batch["after"].to_pylist():
                degrees, _, n = loosened(after)
                sums = np.bincount(np.repeat(np.arange(len(degrees)), degrees), n, len(degrees))
                values.append(np.minimum(np.frexp(sums)[1], BANDS - 1).astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch["part"], batch["first"], pa.array(values, pa.binary())], ["part", "first", "values"])

    return of_words(pairs.select("part", "first", "after").mapInArrow(counted, "part long, first long, values binary"), parts, 0)


def bigrams(pairs: DataFrame, of: np.ndarray, parts: int, symbols: int, empty: int) -> np.ndarray:
    """Symbol bigrams of the training texts, the end of a text before its first word. At most ``symbols`` squared rows.

    ``of``: the symbol of every word by number, the last one that of the end; ``empty``: texts without words."""
    sent = pairs.sparkSession.sparkContext.broadcast(of)

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, total = sent.value.astype(np.int64), np.zeros(symbols * symbols)
        end = len(of) - 1
        for batch in batches:
            for part, first, after, starts in zip(*(batch[x].to_pylist() for x in ("part", "first", "after", "starts")), strict=True):
                degrees, other, n = loosened(after)
                own = of[places_of(part, first, len(degrees), parts)]
                total += np.bincount(np.repeat(own, degrees) * symbols + of[np.minimum(other, end)], n, symbols * symbols)
                _, word, n = loosened(starts)
                total += np.bincount(of[end] * symbols + own[word], n, symbols * symbols)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(total[at].astype(np.int64))], ["pair", "n"])

    rows = pairs.select("part", "first", "after", "starts").mapInArrow(summed, "pair long, n long")
    found = rows.groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    matrix = np.zeros(symbols * symbols)
    matrix[found["pair"].to_numpy()] = found["n"].to_numpy()
    matrix[-1] += empty
    return matrix.reshape(symbols, symbols)


def entropy(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange(matrix: np.ndarray, frequent: int, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for every symbol: the first ``frequent`` ones are exchanged, each other one has a class of its own."""
    symbols, classes = len(matrix), max(1, min(classes, frequent))
    fixed = symbols - frequent
    of = np.concatenate([np.arange(frequent) % classes, classes + np.arange(fixed)])
    total = classes + fixed

    def merged(rows: np.ndarray) -> np.ndarray:
        out = np.zeros((total, rows.shape[1]))
        np.add.at(out, of, rows)
        return out

    table = merged(merged(matrix).T).T
    for _ in range(sweeps):
        moved = False
        for word in range(frequent):
            home = of[word]
            after = np.bincount(of, matrix[word], total)
            before = np.bincount(of, matrix[:, word], total)
            own = matrix[word, word]
            after[home] -= own
            before[home] -= own
            table[home, :] -= after
            table[:, home] -= before
            table[home, home] -= own
            # what goes to and comes from the word counts for the other classes wherever it is put
            outs, ins = table.sum(axis=1) + before, table.sum(axis=0) + after
            gain = (entropy(table[:classes] + after) - entropy(table[:classes])).sum(axis=1)
            gain += (entropy(table[:, :classes] + before[:, None]) - entropy(table[:, :classes])).sum(axis=0)
            here = np.arange(classes)
            diagonal = table[here, here]
            gain += entropy(diagonal + after[:classes] + before[:classes] + own) + entropy(diagonal)
            gain -= entropy(diagonal + after[:classes]) + entropy(diagonal + before[:classes])
            for sums, size in ((outs, after.sum() + own), (ins, before.sum() + own)):
                gain -= entropy(sums[:classes] + size) - entropy(sums[:classes])
            best = int(gain.argmax())
            if gain[best] <= gain[home] + 1e-9:
                best = int(home)
            moved |= best != home
            of[word] = best
            table[best, :] += after
            table[:, best] += before
            table[best, best] += own
        if not moved:
            break
    return of


def likelihood(table: np.ndarray) -> float:
    """What of the likelihood of the training texts the class bigrams decide."""
    return float(entropy(table).sum() - entropy(table.sum(axis=0)).sum() - entropy(table.sum(axis=1)).sum())


def steps_of(rows: np.ndarray) -> np.ndarray:
    """What the likelihood gains where a count of 1 to ``TABLED`` joins a column of each row of a table."""
    lines = np.ascontiguousarray(rows.T)
    return entropy(lines + np.arange(1, TABLED + 1)[:, None, None]) - entropy(lines)


def joined(words: int, word: np.ndarray, column: np.ndarray, n: np.ndarray, rows: np.ndarray, steps: np.ndarray) -> np.ndarray:
    """For words with counts ``n`` by class, and every row of a table: what the likelihood gains where the counts join the row."""
    out = np.zeros((words, len(rows)))
    if not len(word):
        return out
    few = n <= TABLED
    parts = np.empty((len(word), len(rows)))
    parts[few] = steps[n[few].astype(np.int64) - 1, column[few]]
    many = rows.T[column[~few]]
    parts[~few] = entropy(many + n[~few, None]) - entropy(many)
    begins = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    out[word[begins]] = np.add.reduceat(parts, begins)
    return out


def gains(after: np.ndarray, before: np.ndarray, own: np.ndarray, home: np.ndarray, table: np.ndarray, classes: int, steps: tuple | None = None) -> np.ndarray:
    """What the likelihood gains where a word joins each of the first ``classes``, once it is out of its class ``home``.

    ``after``, ``before``: counts of the classes of its neighbours, without its ``own`` after itself; ``steps``: those of the
    table's rows and columns."""
    words, line = len(home), np.arange(len(home))
    sides = ((after, before, table), (before, after, table.T))
    inside, h = home < classes, np.minimum(home, classes - 1)
    gain, stay = np.zeros((words, classes)), np.zeros(words)
    for at, (mine, other, rows) in enumerate(sides):
        word, column = np.divmod(np.flatnonzero(mine), mine.shape[1])
        n, sums = mine[word, column], rows.sum(axis=1)
        gain += joined(words, word, column, n, rows[:classes], steps_of(rows[:classes]) if steps is None else steps[at])
        # the word's bigrams have left the row and the column of its class
        there = rows[h[word], column]
        stay += np.bincount(word, np.where((column == home[word]) | ~inside[word], 0, entropy(there) - entropy(there - n)), words)
        mixed = np.flatnonzero((other[word, home[word]] > 0) & (column < classes))
        w, k, x, y = word[mixed], column[mixed], n[mixed], other[word[mixed], home[word[mixed]]]
        full = rows[home[w], k]
        gain[w, k] += entropy(full - x + y) - entropy(full - x) - entropy(full + y) + entropy(full)
        if not at:
            both = np.flatnonzero((column < classes) & (other[word, np.minimum(column, classes - 1)] > 0) & (own[word] == 0))
            self_word, self_class = (x.ravel() for x in np.meshgrid(np.flatnonzero(own), np.arange(classes), indexing="ij"))
            w, k = np.r_[word[both], self_word], np.r_[column[both], self_class]
            x, y, d = mine[w, k], other[w, k], table[k, k]
            gain[w, k] += entropy(d + x + y + own[w]) + entropy(d) - entropy(d + x) - entropy(d + y)
        total, of = np.unique(mine.sum(axis=1) + own, return_inverse=True)
        gain -= (entropy(sums[:classes] + total[:, None]) - entropy(sums[:classes]))[of]
        stay -= entropy(sums[h]) - entropy(sums[h] - total[of])
    d = table[h, h]
    stay += entropy(d) - entropy(d - after[line, h] - before[line, h] - own)
    gain[line[inside], home[inside]] = stay[inside]
    return gain


def proposed(pairs: DataFrame, of: np.ndarray, parts: int, table: np.ndarray, classes: int) -> np.ndarray:
    """The best class of every word, all others being where they are; by number, as ``of``. Words in none of the ``classes`` go
    to one first, while those in one stay."""
    sent = pairs.sparkSession.sparkContext.broadcast((of, table))
    enter = len(table) > classes + 1

    def moved(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, table = sent.value
        end, size = len(of) - 1, len(table)
        steps = steps_of(table[:classes]), steps_of(table[:, :classes].T)
        for batch in batches:
            values = []
            for part, first, *sides in zip(*(batch[x].to_pylist() for x in ("part", "first", "after", "before")), strict=True):
                sums = []
                for degrees, other, n in map(loosened, sides):
                    places = places_of(part, first, len(degrees), parts)
                    home = of[np.minimum(places, end)].astype(np.int64)
                    word = np.repeat(np.arange(len(degrees)), degrees)
                    own = np.bincount(word, n * (other == places[word]), len(degrees))
                    sums.append(np.bincount(word * size + of[np.minimum(other, end)], n, len(degrees) * size).reshape(-1, size))
                    sums[-1][np.arange(len(degrees)), home] -= own
                gain = gains(*sums, own, home, table, classes, steps)
                best, rows = gain.argmax(axis=1), np.arange(len(home))
                if enter:
                    best = np.where(home < classes, home, best)
                else:
                    best = np.where(gain[rows, best] > gain[rows, home] + 1e-9, best, home)
                values.append(best.astype(np.uint16).tobytes())
            yield pa.RecordBatch.from_arrays([batch["part"], batch["first"], pa.array(values, pa.binary())], ["part", "first", "values"])

    found = of_words(pairs.select("part", "first", "after", "before").mapInArrow(moved, "part long, first long, values binary"), parts, classes)
    sent.destroy()
    return found


def exchanged(pairs: DataFrame, of: np.ndarray, parts: int, matrix: np.ndarray, classes: int, empty: int, sweeps: int = SWEEPS) -> np.ndarray:
    """A class for every word by number. ``of``: where the words begin, in one of the ``classes`` or outside; ``matrix``: bigrams of these symbols.

    All words move at once, so their moves may spoil each other: those that do not raise the likelihood are halved, by lot."""
    of = proposed(pairs, of, parts, matrix, classes)
    table, lot = bigrams(pairs, of, parts, classes + 1, empty), np.random.default_rng(classes)
    for _ in range(sweeps):
        to = proposed(pairs, of, parts, table, classes)
        moves = np.flatnonzero(to != of)
        for _ in range(HALVINGS):
            if not len(moves):
                return of
            next_of = of.copy()
            next_of[moves] = to[moves]
            next_table = bigrams(pairs, next_of, parts, classes + 1, empty)
            if likelihood(next_table) > likelihood(table):
                break
            moves = moves[lot.random(len(moves)) < 0.5]
        else:
            return of
        of, table = next_of, next_table
    return of


@dataclass
class Model:
    """log10 of class transitions and of a symbol in its class; bounded by the symbols and classes."""

    classes: np.ndarray
    transitions: np.ndarray
    emissions: np.ndarray

    @classmethod
    def of(cls, matrix: np.ndarray, frequent: int, classes: int = CLASSES) -> Model:
        """The model of the frequent words and the bands."""
        unseen, once = frequent, frequent + 1
        matrix = matrix.copy()
        for view in (matrix, matrix.T):
            view[unseen] += UNSEEN_SHARE * view[once]
            view[once] *= 1 - UNSEEN_SHARE
        of = exchange(matrix, frequent, classes)
        transitions, _ = cls.between(matrix, of)
        single, n = matrix.sum(axis=0), int(of.max()) + 1
        emissions = np.zeros(len(of))
        emissions[:frequent] = np.log10(np.maximum(single[:frequent], SMOOTHING) / np.maximum(np.bincount(of[:frequent], np.maximum(single[:frequent], SMOOTHING), n)[of[:frequent]], SMOOTHING))
        words = slice(once, len(of) - 1)
        held = single[words].copy()
        if len(held):
            held[0] /= 1 - UNSEEN_SHARE
        emissions[words] = -np.log10(np.maximum(held, 1))
        return cls(of, np.log10(transitions), emissions)

    @staticmethod
    def between(matrix: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Probabilities of a class after each class, and the sizes of the classes."""
        n = int(of.max()) + 1
        table = np.zeros((n, n))
        np.add.at(table, (of[:, None], of[None, :]), matrix)
        sizes = np.bincount(of, matrix.sum(axis=0), n)
        usual = (sizes + SMOOTHING) / (sizes.sum() + SMOOTHING * n)
        return (table + BACK_OFF * usual) / (table.sum(axis=1, keepdims=True) + BACK_OFF), sizes

    @classmethod
    def whole(cls, matrix: np.ndarray, classes: int) -> Model:
        """The model of all words. Symbols: the classes for words seen more than once, the same for words seen once, unseen words, the end."""
        once, unseen = slice(classes, 2 * classes), 2 * classes
        matrix = matrix.copy()
        for view in (matrix, matrix.T):
            view[unseen] += UNSEEN_SHARE * view[once].sum(axis=0)
            view[once] *= 1 - UNSEEN_SHARE
        line = np.arange(classes)
        of = np.concatenate([line, line, [classes, classes + 1]])
        transitions, sizes = cls.between(matrix, of)
        share = -np.log10(np.maximum(sizes[:classes], SMOOTHING))
        return cls(of, np.log10(transitions), np.concatenate([share, share + math.log10(1 - UNSEEN_SHARE), [0.0, 0.0]]))

    def score(self, symbols: np.ndarray, rest: float) -> float:
        """log10 probability of a text and its end; ``rest``: log10 of the counts of its words."""
        line = np.concatenate([symbols, [len(self.classes) - 1]])
        path = self.classes[line]
        before = np.concatenate([path[-1:], path[:-1]])
        return float(self.transitions[before, path].sum() + self.emissions[line].sum() + rest)


def score(docs: DataFrame, held_out: Column, frequent: int = FREQUENT, classes: int = CLASSES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, perplexity`` of every whole text.

    Tokens are words without white space, A to Z in lower case, and one end. The model learns from rows for which
    ``held_out`` (a condition on ``doc_id``) is false. ``base_score`` is the unigram score with 0.1 added to each count.
    A null text is empty and has its end alone. Rows with null or repeated ids are scored like others. Without
    training rows every count is 0 and all words are unseen.
    """
    spark = docs.sparkSession
    small_batches(spark)
    buckets = partitions(spark)
    docs = identified(docs).withColumn("training", ~held_out)
    spread = F.when(F.col("doc_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("doc_id"))
    blocks = docs.withColumn("_block", F.pmod(spread, F.lit(2 * buckets))).repartition(buckets, "_block")

    def count_block(table: pa.Table) -> pa.Table:
        return counted(table, buckets)

    def encode_block(key: tuple, block: pa.Table, lists: pa.Table) -> pa.Table:
        return encoded(block if block.num_rows else block.schema.empty_table(), lists)

    lists = blocks.groupBy("_block").applyInArrow(count_block, "bucket long, block long, words string, counts binary")
    by_word = lists.groupBy("bucket")
    tops = by_word.applyInArrow(lambda table: top_words(table, frequent), "top array<string>, top_counts array<long>")
    totals = by_word.applyInArrow(lambda table: totalled(table, frequent, buckets), "block long, words string, counts binary, numbers binary, owned long")
    everywhere = spark.range(2 * buckets).select(F.col("id").alias("block")).crossJoin(F.broadcast(frequent_words(tops, frequent)))
    back = totals.select(*LIST).unionByName(everywhere, allowMissingColumns=True)
    texts = written(blocks.groupBy("_block").cogroup(back.groupBy("block")).applyInArrow(encode_block, ENCODED), "symbols")
    sums = texts.agg(
        F.sum(F.when(~F.col("held_out"), F.col("n_words") + 1)).alias("tokens"), F.sum("owned").alias("words"), F.sum((~F.col("held_out")).cast("long")).alias("ends"),
        F.count_if(~F.col("held_out") & (F.col("n_words") == 0)).alias("empty"),
    ).first()
    tokens, ends = sums["tokens"] or 0, sums["ends"] or 0
    distinct = (sums["words"] or 0) + (1 if ends else 0)
    clustered = min(frequent, sums["words"] or 0)
    parts, empty = max(buckets, math.ceil(tokens / PART_TOKENS)), sums["empty"]
    pairs = neighbours(texts, parts)
    band = bands(pairs, parts)
    known, number = band[:-1], np.arange(len(band) - 1)
    symbols = np.r_[np.where(number < clustered, number, clustered + known.astype(np.int64)), clustered + BANDS]
    matrix = bigrams(pairs, symbols.astype(np.uint16), parts, clustered + BANDS + 1, empty)
    first = Model.of(matrix, clustered, classes).classes
    classes, table = int(first[clustered]), np.zeros((int(first.max()) + 1,) * 2)
    np.add.at(table, (first[:, None], first[None, :]), matrix)
    of = exchanged(pairs, first[symbols].astype(np.uint16), parts, table, classes, empty)[:-1].astype(np.int64)
    symbols = np.r_[of + classes * (known == 1), 2 * classes + 1].astype(np.uint16)
    model = Model.whole(bigrams(pairs, symbols, parts, 2 * classes + 2, empty), classes)
    symbols[-1] = 2 * classes
    sent = spark.sparkContext.broadcast((symbols, model))

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        symbols, model = sent.value
        for batch in batches:
            texts = (symbols[np.minimum(np.frombuffer(x, "<u4"), len(symbols) - 1)] for x in batch["symbols"].to_pylist())
            found = [model.score(text, rest) for text, rest in zip(texts, batch["rest"].to_pylist(), strict=True)]
            kept = [batch[x] for x in ("doc_id", "held_out", "n_words", "n_known", "base")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(found, pa.float64())], ["doc_id", "held_out", "n_words", "n_known", "base", "score"])

    rows = texts.select("doc_id", "held_out", "n_words", "n_known", "base", "rest", "symbols").mapInArrow(
        scored, "doc_id long, held_out boolean, n_words long, n_known long, base double, score double"
    )
    n_tokens = F.col("n_words") + 1
    whole = math.log10(tokens + SMOOTHING * (distinct + 1))
    return rows.select(
        "doc_id",
        "held_out",
        n_tokens.alias("n_tokens"),
        (F.col("n_known") + F.lit(1 if ends else 0)).alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        (F.col("base") + math.log10(ends + SMOOTHING) - n_tokens * whole).alias("base_score"),
        "score",
        F.pow(10.0, -F.col("score") / n_tokens).alias("perplexity"),
    )
