"""Token counts under a unigram model, with the pre-tokens of a batch in a trie.

A pre-token is a word with the mark that stands for the space before it. The best score of a prefix under a unigram
model depends on that prefix alone, so the pre-tokens are walked in sorted order, which is a depth-first walk of their
trie: what the last pre-token shares with the next keeps its forward scores, and only new nodes are
computed. The terminal node of a pre-token stores how many tokens its best split has.

Pieces come from a public vocabulary. Its ranks are those of a frequency order, so a piece of rank r scores as Zipf's law
has it: minus the logarithm of r + 1, normalized. A character that no piece covers is written as its bytes and
scores as the last rank for each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import WORD, Memo, identified, kept_by_worker, small_batches

#: Fixed value: how piece vocabularies write the space before a word.
SPACE_MARK = "▁"


def zipf_scores(ranks: int) -> list[float]:
    total = math.log(math.fsum(1 / (rank + 1) for rank in range(ranks)))
    return [-math.log(rank + 1) - total for rank in range(ranks)]


class UnigramTrie:
    """Forward scores along the trie of sorted pre-tokens.

    The pieces that end at a node are known from its state in a keyword automaton of all pieces. Of two splits
    with the same score the one with fewer tokens wins, then the one whose last piece is shorter.
    """

    def __init__(self, pieces: dict[str, float], unknown: float):
        self.unknown = unknown
        self.steps: dict[tuple[int, str], int] = {}
        self.ends: list[list[tuple[int, float]]] = [[]]
        self.back = [0]
        depth = {0: 0}
        for piece, score in pieces.items():
            state = 0
            for size, char in enumerate(piece, 1):
                if (state, char) not in self.steps:
                    self.steps[state, char] = len(self.ends)
                    depth[len(self.ends)] = size
                    self.ends.append([])
                    self.back.append(0)
                state = self.steps[state, char]
            self.ends[state].append((len(piece), score))
        for (state, char), child in sorted(self.steps.items(), key=lambda x: depth[x[1]]):
            if state:
                self.back[child] = self.step(self.back[state], char)
            self.ends[child] = sorted(self.ends[child] + self.ends[self.back[child]])
        self.moves = Memo(lambda move: self.step(*move))
        #: Counts of words met before.
        self.known = Memo(None)

    def step(self, state: int, char: str) -> int:
        """The longest suffix read that begins a piece."""
        while (state, char) not in self.steps and state:
            state = self.back[state]
        return self.steps.get((state, char), 0)

    def extend(self, word: str, rows: list[tuple[float, int, int, int]]) -> None:
        """Forward rows (score, minus tokens, state, size of the last piece) of all prefixes of ``word``.

        ``rows`` holds those of a shared prefix already."""
        moves, ends = self.moves, self.ends
        for end in range(len(rows), len(word) + 1):
            char = word[end - 1]
            state = moves[rows[-1][2], char]
            found = ends[state]
            if found and found[0][0] == 1:
                top, most, best = -math.inf, 0, 0
            else:
                spelled = len(char.encode("utf-8", "replace"))
                top, most, best = rows[-1][0] + self.unknown * spelled, rows[-1][1] - spelled, 0
            for size, score in found:
                before = rows[end - size]
                score += before[0]
                if score > top or score == top and before[1] - 1 > most:
                    top, most, best = score, before[1] - 1, size
            rows.append((top, most, state, best))

    def terminals(self, words: list[str]) -> dict[str, tuple[int, float]]:
        """Token count and score of each word; ``words`` in any order."""
        found, before, rows = {}, "", [(0.0, 0, 0, 0)]
        for word in sorted(words):
            shared = 0
            for a, b in zip(before, word):  # noqa: B905
                if a != b:
                    break
                shared += 1
            del rows[shared + 1 :]
            self.extend(word, rows)
            found[word] = (-rows[-1][1], rows[-1][0])
            before = word
        return found

    def split(self, word: str) -> list[str]:
        """The pieces of the best split; a character without a piece gives one entry per byte."""
        rows = [(0.0, 0, 0, 0)]
        self.extend(word, rows)
        out, end = [], len(word)
        while end:
            size = rows[end][3]
            out += [word[end - size : end]] if size else [f"<0x{x:02X}>" for x in reversed(word[end - 1].encode("utf-8", "replace"))]
            end -= size or 1
        return out[::-1]


def trie_of(vocabulary: str) -> UnigramTrie:
    return kept_by_worker("counts", vocabulary, lambda: read_trie(vocabulary))


def read_trie(vocabulary: str) -> UnigramTrie:
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=vocabulary)
    usual = [x for x in range(model.get_piece_size()) if not (model.is_byte(x) or model.is_control(x) or model.is_unknown(x))]
    usual.sort(key=lambda x: (-model.get_score(x), x))
    scores = zipf_scores(len(usual))
    return UnigramTrie({model.id_to_piece(x): score for x, score in zip(usual, scores, strict=True)}, scores[-1])


def count_tokens(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_words, n_tokens, score`` of every whole text, in place, without a shuffle.

    Distinct pre-tokens of a batch enter the trie together; those met before keep their counts in a bounded cache.
    A null or empty text has no words, no tokens and score 0. Rows with null or repeated ids are counted like others.
    """
    small_batches(docs.sparkSession)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(vocabulary)
        known = trie.known
        for batch in batches:
            texts = [WORD.findall(text) if text else [] for text in batch["text"].to_pylist()]
            seen: set[str] = set()
            for words in texts:
                seen.update(words)
            counts, scores, missing = {}, {}, []
            for word in seen:
                value = known.recall(word)
                if value is None:
                    missing.append(SPACE_MARK + word)
                else:
                    counts[word], scores[word] = value
            for marked, value in trie.terminals(missing).items():
                counts[marked[1:]], scores[marked[1:]] = known.keep(marked[1:], value)
            arrays = [
                batch["doc_id"],
                pa.array([len(words) for words in texts], pa.int64()),
                pa.array([sum(map(counts.__getitem__, words)) for words in texts], pa.int64()),
                pa.array([math.fsum(map(scores.__getitem__, words)) for words in texts], pa.float64()),
            ]
            yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_tokens", "score"])

    return identified(docs, id_col, text_col).mapInArrow(counted, "doc_id long, n_words long, n_tokens long, score double")


def word_counts(docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``word, occurrences, n_tokens`` of every distinct pre-token of the corpus.

    Words are counted with a map-side combine, so a frequent word is one row per task; each task then walks the trie of
    its own words once.
    """
    words = F.explode(F.regexp_extract_all(F.col("text"), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    counts = identified(docs, id_col, text_col).select(words.alias("word")).groupBy("word").agg(F.count("*").alias("occurrences"))

    def walked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = trie_of(vocabulary)
        for batch in batches:
            marked = [SPACE_MARK + word for word in batch["word"].to_pylist()]
            found = trie.terminals(marked)
            tokens = pa.array([found[word][0] for word in marked], pa.int64())
            yield pa.RecordBatch.from_arrays([batch["word"], batch["occurrences"], tokens], ["word", "occurrences", "n_tokens"])

    return counts.mapInArrow(walked, "word string, occurrences long, n_tokens long")
