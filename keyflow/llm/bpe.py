"""Byte-pair encoding with a tokenization automaton, and decoding by its arc labels.

The automaton reads tokens. Its states are the tokens read last; at first it has the 256 bytes and every arc.
Each merge ``(a, b) -> c`` is a gadget: the state of ``c`` gets the arcs that leave ``b``, the arcs that enter
``c`` are those that enter ``a``, and the arc from ``a`` by ``b`` goes. After the last gadget it accepts exactly
one token path for every byte string, and that path is what applying the merges in order gives. Copied arc
sets are not written out: an arc is looked up through the gadgets that copied it and then kept in a
transition table. A pre-split word is encoded from left to right by the longest arc that leaves the state; a
position without a way on is left for good.
"""

from __future__ import annotations

import json
from array import array
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import pre_tokenizers

from keyflow.llm.common import Memo, identified, kept_by_worker, list_array, small_batches

#: Fixed value: the split rule of byte-level vocabularies.
SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
LIBRARY_SPLIT = pre_tokenizers.ByteLevel(add_prefix_space=False)
#: A space after a space character can belong to a longer run; elsewhere a space always starts a word.
RUN_OF_SPACE = regex.compile(r"\s ")
CHUNK = regex.compile(r"\s*\S+|\s+")
#: What the caches of transitions, pre-splits and words after a space hold. An executor has a worker or two for each core.
TABLE_ENTRIES = 400_000
SPLIT_ENTRIES = 100_000
SPACED_ENTRIES = 300_000
#: Ids whose labels are gathered at once.
PIECE_IDS = 1 << 20
#: Below this code point the classes of letters, digits and spaces are the same in all versions of Unicode in use.
SETTLED = "\u0530"


def byte_of_symbol() -> dict[str, int]:
    """Byte-level vocabularies write printable bytes as themselves and the others as symbols from 256 on."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = sorted(set(range(256)) - set(shown))
    return {chr(byte): byte for byte in shown} | {chr(256 + i): byte for i, byte in enumerate(hidden)}


def split(chunk: str) -> list[str]:
    """Pre-splits; characters whose class depends on the version of Unicode are left to the library's own splitter."""
    if max(chunk) < SETTLED:
        return SPLIT.findall(chunk)
    return [chunk[a:b] for _, (a, b) in LIBRARY_SPLIT.pre_tokenize_str(chunk)]


class Automaton:
    """The automaton of one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        symbols, model = byte_of_symbol(), spec["model"]
        self.ids = len(model["vocab"]) + len(spec["added_tokens"])
        self.labels = labels_of(spec)
        self.born = {model["vocab"][symbol]: 0 for symbol in symbols}
        self.parts: dict[int, tuple[int, int]] = {}
        self.removed: dict[int, int] = {}
        for step, merge in enumerate(model["merges"], 1):
            first, second = merge.split(" ") if isinstance(merge, str) else merge
            self.add_gadget(step, model["vocab"][first], model["vocab"][second], model["vocab"][first + second])
        self.extra = {token["content"]: token["id"] for token in spec["added_tokens"]}
        self.extra_split = regex.compile("|".join(map(regex.escape, sorted(self.extra, key=len, reverse=True)))) if self.extra else None
        self.steps = len(model["merges"])
        self.table = Memo(lambda pair: self.arc(*divmod(pair, self.ids), self.steps), TABLE_ENTRIES)
        self.grow_tree()
        self.words = Memo(self.encode_word, SPLIT_ENTRIES)
        self.spaced = Memo(self.encode_spaced, SPACED_ENTRIES)

    def add_gadget(self, step: int, first: int, second: int, merged: int) -> None:
        known = first in self.born and second in self.born
        if known and merged not in self.born and self.arc(first, second, step - 1):
            self.born[merged], self.parts[merged] = step, (first, second)
            self.removed[first * self.ids + second] = step

    def arc(self, state: int, token: int, step: int) -> bool:
        """Whether ``token`` leaves ``state`` after so many gadgets."""
        while self.removed.get(state * self.ids + token, step + 1) > step:
            out, into = self.born[state], self.born[token]
            if out == into == 0:
                return True
            if out >= into:
                step = min(step, out - 1)
                token = self.parts[token][0] if out == into else token
                state = self.parts[state][1]
            else:
                step, token = min(step, into), self.parts[token][0]
        return False

    def grow_tree(self) -> None:
        """The tokens' bytes as a tree, to find the arcs that can follow at a position. Below -1: the token."""
        self.tree: dict = {}
        self.longest = max((len(self.labels[number]) for number in self.born), default=0)
        for number in self.born:
            node = self.tree
            for byte in self.labels[number]:
                node = node.setdefault(byte, {})
            node[-1] = number

    def encode_word(self, word: str) -> bytes:
        """The ids of a pre-split word, as packed 32-bit numbers.

        Follows the longest arc first. The path to a position is unique, so a position without a way on is
        left for good and no position is tried twice.
        """
        data = word.encode("utf-8", "replace")
        size, tree, table, ids, longest = len(data), self.tree, self.table, self.ids, self.longest
        path, ways, closed, at, state = [], [], set(), 0, -1
        while at < size:
            node, found = tree, []
            for byte in data[at : at + longest]:
                node = node.get(byte)
                if node is None:
                    break
                found.append(node)
            while True:
                if not found:
                    closed.add(at)
                    found = ways.pop()
                    path.pop()
                    at, state = path[-1] if path else (0, -1)
                    continue
                end, token = at + len(found), found.pop().get(-1)
                if token is not None and end not in closed and (state < 0 or table[state * ids + token]):
                    break
            ways.append(found)
            at, state = end, token
            path.append((at, state))
        return array("i", [token for _, token in path]).tobytes()

    def encode_plain(self, text: str) -> bytes:
        if RUN_OF_SPACE.search(text):
            return b"".join([self.encode_chunk(chunk) for chunk in CHUNK.findall(text)])
        first, *rest = text.split(" ")
        return self.encode_chunk(first) + b"".join(map(self.spaced.__getitem__, rest))

    def encode_chunk(self, chunk: str) -> bytes:
        """Several pre-splits that end where no other one can begin earlier or later."""
        return b"".join(map(self.words.__getitem__, split(chunk))) if chunk else b""

    def encode_spaced(self, word: str) -> bytes:
        """A word after a space; one that is a single pre-split is not kept among these as well."""
        parts = split(" " + word)
        return self.encode_word(parts[0]) if len(parts) == 1 else b"".join(map(self.words.__getitem__, parts))

    def encode(self, text: str) -> bytes:
        if not self.extra_split or not (hits := [*self.extra_split.finditer(text)]):
            return self.encode_plain(text)
        out, at = [], 0
        for hit in hits:
            out += [self.encode_plain(text[at : hit.start()]), np.array([self.extra[hit[0]]], "<i4").tobytes()]
            at = hit.end()
        return b"".join([*out, self.encode_plain(text[at:])])

    def decode(self, ids: list[int]) -> str:
        return text_of(self.labels, ids)


def labels_of(spec: dict) -> dict[int, bytes]:
    """The bytes of every token."""
    symbols = byte_of_symbol()
    labels = {number: bytes(symbols[x] for x in token) for token, number in spec["model"]["vocab"].items()}
    return labels | {token["id"]: token["content"].encode() for token in spec["added_tokens"]}


def text_of(labels: dict[int, bytes], ids: list[int]) -> str:
    try:
        data = b"".join(map(labels.__getitem__, ids))
    except KeyError:
        data = b"".join([labels.get(x, b"") for x in ids])
    return data.decode("utf-8", "replace")


class Labels:
    """The bytes of all tokens in one row, gathered for many ids at once."""

    def __init__(self, labels: dict[int, bytes]):
        size = max(labels, default=-1) + 2
        self.lengths = np.zeros(size, np.int64)
        self.lengths[list(labels)] = [len(label) for label in labels.values()]
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.bytes = np.frombuffer(b"".join(labels.get(number, b"") for number in range(size)), np.uint8)

    def joined(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The labels of the ids one after the other, and where each one ends. Unknown ids have the empty last label."""
        known = (ids >= 0) & (ids < len(self.lengths))
        ids = ids if known.all() else np.where(known, ids, len(self.lengths) - 1)
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        total = int(ends[-1]) if len(ends) else 0
        return self.bytes[np.repeat(self.starts[ids] - (ends - lengths), lengths) + np.arange(total)], ends

    def texts(self, ids: np.ndarray, offsets: np.ndarray) -> list[str]:
        """The text of each stretch of ids; a stretch of any length is gathered piece by piece."""
        out: list[str] = []
        row, last = 0, len(offsets) - 1
        while row < last:
            begin, upto = int(offsets[row]), max(row + 1, int(np.searchsorted(offsets, offsets[row] + PIECE_IDS, "right")) - 1)
            if upto > row + 1 or offsets[upto] - begin <= PIECE_IDS:
                data, ends = self.joined(ids[begin : int(offsets[upto])])
                ends = np.concatenate([[0], ends])[offsets[row : upto + 1] - begin].tolist()
                data = data.tobytes()
                out += [data[a:b].decode("utf-8", "replace") for a, b in zip(ends[:-1], ends[1:], strict=True)]
            else:
                pieces = [self.joined(ids[at : min(at + PIECE_IDS, int(offsets[upto]))])[0] for at in range(begin, int(offsets[upto]), PIECE_IDS)]
                out.append(b"".join(piece.tobytes() for piece in pieces).decode("utf-8", "replace"))
            row = upto
        return out


def labels_in(path: str) -> Labels:
    def read() -> Labels:
        with open(path, encoding="utf-8") as file:
            return Labels(labels_of(json.load(file)))

    return kept_by_worker("bpe", f"labels {path}", read)


def automaton(path: str) -> Automaton:
    return kept_by_worker("bpe", f"automaton {path}", lambda: Automaton(path))


def encoded(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    machine = automaton(vocabulary)
    for batch in batches:
        parts = [machine.encode(text) if text else b"" for text in batch["text"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["doc_id"], list_array(parts)], ["doc_id", "ids"])


def decoded(vocabulary: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels = labels_in(vocabulary)
    for batch in batches:
        lists = batch["ids"].fill_null([]) if batch["ids"].null_count else batch["ids"]
        texts = labels.texts(lists.values.fill_null(-1).to_numpy(), lists.offsets.to_numpy().astype(np.int64))
        yield pa.RecordBatch.from_arrays([batch["doc_id"], batch["ids"], pa.array(texts, pa.string())], ["doc_id", "ids", "text"])


def encode(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, ids`` of every whole text, in place: no shuffle, and one batch of texts in memory.

    A null text is an empty one and has no ids; strings of added tokens in a text become those tokens.
    Rows with a null or repeated id are encoded like all others.
    """
    small_batches(docs.sparkSession)
    return identified(docs, id_col, text_col).mapInArrow(partial(encoded, vocabulary), "doc_id long, ids array<int>")


def decode(tokens: DataFrame, vocabulary: str) -> DataFrame:
    """Adds ``text``: the labels of the ids in a row; bytes that are no UTF-8 become U+FFFD, unknown ids nothing."""
    small_batches(tokens.sparkSession)
    return tokens.select("doc_id", "ids").mapInArrow(partial(decoded, vocabulary), "doc_id long, ids array<int>, text string")


def round_trip(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``decode(encode(docs))`` in one Python function. Two in a row take two workers a task, and as workers change their
    parts from task to task, all of them come to hold the caches of both."""
    small_batches(docs.sparkSession)

    def both(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return decoded(vocabulary, encoded(vocabulary, batches))

    return identified(docs, id_col, text_col).mapInArrow(both, "doc_id long, ids array<int>, text string")


def digests(tokens: DataFrame) -> DataFrame:
    """Counts and hashes of the ids and of the decoded text."""
    ids = F.coalesce(F.col("ids"), F.array().cast("array<int>"))
    return tokens.select(
        "doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("text").cast("binary"), 256).alias("decoded_sha256"),
    )
