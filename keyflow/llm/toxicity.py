"""Toxicity by maximum-scoring segments: which passages of a text are toxic, and how surely the text is.

Every word has a score: the log-odds of its occurrence in toxic and other texts under a Dirichlet prior that follows the
word's share of both, pulled to zero by twice its standard error. All words cost a drift, so that a random text's sum falls and only
stretches with words of toxic texts rise. The maximal scoring segments of a text (those of which no part can be left out or
added to gain) are found by one scan over its words of the model, in linear time.

The best segment of a random text follows an extreme-value distribution: a text of n words has about ``K n exp(-lambda S)``
segments of score S or more by chance. ``lambda`` is the positive root of the sum of ``p exp(lambda s)`` = 1 over the words
of other texts, ``K`` follows from their best segments. A passage is significant if chance gives less than one in
twenty of it. A text's evidence is what its segments are above chance, in logarithms, and a logistic curve over it, fitted on
texts that the word scores don't know, gives the score.

The model is fitted on a bounded sample of labelled rows and has a bounded number of words. Texts are scored in place.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import small_batches
from keyflow.llm.components import written

WORDS = re.compile(r"[^\W\d_]+")
#: Labelled rows that the model is fitted on at most, chosen by a hash of the id.
SAMPLE_ROWS = 60_000
#: Words of the model at most, those with the largest scores.
FEATURES = 50_000
#: One part in so many of the sample is for the curve, the rest for the words.
PARTS = 4
#: The prior: half a text for every word, and this share of the texts that have it.
PRIOR_TEXTS = 0.5
PRIOR_SHARE = 0.002
ERRORS = 2.0
DRIFT = 0.5
MOST_RATE = 3.0
SIGNIFICANT = 0.05
EULER = 0.5772156649015329
PASSAGE = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("chance", pa.float64())])


def words_of(text: str) -> list[str]:
    """Runs of letters in lower case, one for each run of the text."""
    return WORDS.findall(text.lower()) if text.isascii() else [word.lower() for word in WORDS.findall(text)]


def maximal_segments(hits: list[tuple[int, float]], drift: float) -> list[tuple[int, int, float]]:
    """All maximal scoring segments: first word, end, score. ``hits``: places and scores (before the drift) of the words
    that have one, in order; every word costs the drift."""
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum after, nearest with a smaller sum before
    total, behind = 0.0, -1
    for at, score in hits:
        total -= drift * (at - behind - 1)
        before, behind = total, at
        total += score - drift
        if total <= before:
            continue
        first, low = at, before
        while True:
            link = len(found) - 1
            while link >= 0 and found[link][2] >= low:
                link = found[link][4]
            if link < 0 or found[link][3] >= total:
                found.append((first, at + 1, low, total, link))
                break
            first, low = found[link][0], found[link][2]
            del found[link:]
    return [(first, end, high - low) for first, end, low, high, _ in found]


@dataclass
class Model:
    """``scores`` by word; ``rate`` and ``log_k`` of the extreme-value distribution; the curve's offset and slope."""

    scores: dict[str, float] = field(default_factory=dict)
    drift: float = DRIFT
    rate: float = 1.0
    log_k: float = 0.0
    offset: float = -math.inf
    slope: float = 0.0

    def segments(self, text: str | None) -> tuple[int, list[tuple[int, int, float]]]:
        words = words_of(text) if text else []
        scores = self.scores
        hits = [(at, scores[word]) for at, word in enumerate(words) if word in scores]
        return len(words), maximal_segments(hits, self.drift)

    def log_chance(self, score: float, n: int) -> float:
        """Logarithm of the number of such segments that chance gives."""
        return self.log_k + math.log(max(n, 1)) - self.rate * score

    def evidence(self, n: int, segments: list[tuple[int, int, float]]) -> float:
        return math.log1p(sum(max(0.0, -self.log_chance(score, n)) for _, _, score in segments))

    def score(self, evidence: float) -> float:
        return 0.0 if self.offset == -math.inf else 1 / (1 + math.exp(-max(-700.0, min(700.0, self.offset + self.slope * evidence))))

    def passages(self, text: str, n: int, segments: list[tuple[int, int, float]]) -> list[dict]:
        """Significant segments with their places in the text, end exclusive."""
        found = [(first, end, score, math.exp(min(0.0, self.log_chance(score, n)))) for first, end, score in segments]
        found = [x for x in found if x[3] < SIGNIFICANT]
        if not found:
            return []
        spans = [match.span() for match in WORDS.finditer(text)]
        return [{"start": spans[first][0], "end": spans[end - 1][1], "score": score, "chance": chance} for first, end, score, chance in found]


def sampled(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int) -> DataFrame:
    """``text, toxic, part``: texts of a bounded number of labelled rows, equal texts once, with the label of most."""
    rows = labels.where(learn & F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
    rows = rows.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.max((F.col("toxic") == 1).cast("int")).alias("toxic"))
    chosen = written(rows.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows), "labelled")
    texts = docs.where("text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    known = texts.join(F.broadcast(chosen), "doc_id").groupBy("text").agg((F.avg("toxic") >= 0.5).alias("toxic"))
    return written(known.withColumn("part", F.pmod(F.xxhash64("text"), F.lit(PARTS)).cast("int")), "sample")


def word_counts(sample: DataFrame) -> DataFrame:
    """``word, toxic, clean``: texts of the sample that have the word."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = Counter(), Counter()
            for text, toxic in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                counts[toxic].update(set(words_of(text)))
            words = [*(counts[0] | counts[1])]
            both = [pa.array([found[word] for word in words], pa.int64()) for found in (counts[1], counts[0])]
            yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), *both], ["word", "toxic", "clean"])

    rows = sample.select("text", "toxic").mapInArrow(counted, "word string, toxic bigint, clean bigint")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def word_scores(counts: DataFrame, features: int) -> tuple[dict[str, float], dict[str, int], int]:
    """Scores of at most ``features`` words, their clean counts, and the sum of all clean counts."""
    n_toxic, n_clean, n_words = (int(x or 0) for x in counts.agg(F.sum("toxic"), F.sum("clean"), F.count("*")).first())
    if not n_toxic or not n_clean:
        return {}, {}, n_clean
    prior = F.lit(PRIOR_TEXTS) + PRIOR_SHARE * (F.col("toxic") + F.col("clean"))
    mass = PRIOR_TEXTS * n_words + PRIOR_SHARE * (n_toxic + n_clean)
    a, b = F.col("toxic") + prior, F.col("clean") + prior
    odds = F.log(a / (n_toxic + mass - a)) - F.log(b / (n_clean + mass - b))
    sure = F.greatest(F.abs(odds) - ERRORS * F.sqrt(1 / a + 1 / b), F.lit(0.0))
    rows = counts.select("word", "clean", (F.signum(odds) * sure).alias("score")).where("score <> 0")
    found = rows.orderBy(F.desc(F.abs("score")), "word").limit(features).collect()
    return {r["word"]: r["score"] for r in found}, {r["word"]: r["clean"] for r in found}, n_clean


def decay(scores: np.ndarray, shares: np.ndarray, drift: float) -> float:
    """The positive root of ``sum(p exp(rate (s - drift))) = 1``; what the scored words leave of the shares scores 0."""

    def excess(rate: float) -> float:
        return float((shares * np.exp(rate * (scores - drift))).sum() + max(0.0, 1 - shares.sum()) * math.exp(-rate * drift)) - 1

    if excess(MOST_RATE) <= 0:
        return MOST_RATE
    low, high = 0.0, MOST_RATE
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if excess(middle) < 0 else (low, middle)
    return high


def logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Offset and slope (not below 0) of the most likely logistic curve, with a weak pull to no slope."""
    share = (y.sum() + 0.5) / (len(y) + 1)
    at = np.array([math.log(share / (1 - share)), 0.0])
    design = np.column_stack([np.ones(len(x)), x])
    pull = np.diag([1e-6, 1e-2])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ at, -30, 30)))
        step = np.linalg.solve(design.T @ (design * (p * (1 - p))[:, None]) + pull, design.T @ (y - p) - pull @ at)
        at += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    if at[1] < 0:
        return math.log(share / (1 - share)), 0.0
    return float(at[0]), float(at[1])


def fit(docs: DataFrame, labels: DataFrame, learn: Column, sample_rows: int = SAMPLE_ROWS, features: int = FEATURES) -> Model:
    """Fits on texts of rows of ``labels`` (``doc_id, toxic``) that ``learn`` selects, ``sample_rows`` at most.

    A label is toxic if it is 1; null labels, ids and texts teach nothing. An id that is labelled more than once is toxic if
    one of its labels is. Rows that share an id have its label. Without a labelled text the model gives 0 to all.
    """
    small_batches(docs.sparkSession)
    sample = sampled(docs, labels, learn, sample_rows)
    scores, clean, n_clean = word_scores(written(word_counts(sample.where("part <> 0")), "words"), features)
    values = np.fromiter(scores.values(), float, len(scores))
    shares = np.fromiter(clean.values(), float, len(clean)) / max(1, n_clean)
    drift = DRIFT + max(0.0, float(values @ shares))
    model = Model(scores, drift, decay(values, shares, drift))

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.segments(text) for text in batch["text"].to_pylist()]
            sizes = pa.array([n for n, _ in found], pa.int64())
            segments = pa.array([[score for _, _, score in segments] for _, segments in found], pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch["toxic"], batch["part"], sizes, segments], ["toxic", "part", "n", "scores"])

    held = sample.where("part = 0") if not sample.where("part = 0").isEmpty() else sample
    rows = held.select("text", "toxic", "part").mapInArrow(best, "toxic boolean, part int, n bigint, scores array<double>").toArrow().to_pylist()
    if not rows:
        return model
    tops = [model.rate * max(row["scores"], default=0.0) - math.log(max(row["n"], 1)) for row in rows if not row["toxic"]]
    model.log_k = float(np.mean(tops)) - EULER if tops else 0.0
    x = np.array([model.evidence(row["n"], [(0, 0, score) for score in row["scores"]]) for row in rows])
    model.offset, model.slope = logistic(x, np.array([row["toxic"] for row in rows], float))
    return model


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """Adds ``score`` (0 to 1), ``predicted`` (1 from a score of 0.5) and ``passages`` to the columns of ``docs`` (columns
    of these names are replaced).

    A passage has its first character, its end, its score and how many such ones chance gives. A text that is null, empty or
    without letters has no passage and the score of a text without evidence. Texts of any length are scored whole. Only
    ``text`` is read; every row comes back, repeated rows with equal results.
    """
    small_batches(docs.sparkSession)
    added = {"score": "double", "predicted": "int", "passages": "array<struct<start:int,end:int,score:double,chance:double>>"}
    docs = docs.drop(*added)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores, passages = [], []
            for text in batch["text"].to_pylist():
                n, segments = model.segments(text)
                scores.append(model.score(model.evidence(n, segments)))
                passages.append(model.passages(text, n, segments) if segments else [])
            new = [pa.array(scores, pa.float64()), pa.array([int(x >= 0.5) for x in scores], pa.int32()), pa.array(passages, pa.list_(PASSAGE))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *added])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in added.items()])
    return docs.mapInArrow(scored, schema)
