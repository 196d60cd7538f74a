"""Language identification: scripts narrow the candidates, word scores vote, Viterbi labels spans.

A word is a run of letters. Its script leaves the languages that were learned to use it; each of them scores the word by
the letter n-grams that were learned for it. A path over the words of a document pays a penalty for each change of
language; the best path labels the spans of a mixed text. Most texts have one language: where no stretch of words gains
half the penalty by any other language, the best path has no change, and that is found without the loop over words. (A
path of m stretches pays m - 1 changes, so m gains are less than its penalties if each is less than half of one.)
"""

from __future__ import annotations

import bisect
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keyflow.llm.common import Memo, alone, kept_by_worker, small_batches

UNDETERMINED = "und"
LETTERS = re.compile(r"[^\W\d_]+")
#: Documents per language that the model is fitted on, about; chosen by a hash of the id.
SAMPLE_DOCS = 600
#: Bounds of the model: n-grams kept, most frequent first, and languages, most documents first.
FEATURES = 60_000
LANGUAGES = 200
#: A language uses a script if at least this share of its letters are of it.
SCRIPT_SHARE = 0.01
SWITCH_PENALTY = 15.0
SMOOTHING = 0.5
#: What a word costs in a language that doesn't use its script.
FOREIGN = 8.0
#: First code points of script ranges, as Unicode's blocks have them; None: no script of its own.
SCRIPTS: list[tuple[int, str | None]] = [
    (0x0000, "Latin"), (0x0370, "Greek"), (0x0400, "Cyrillic"), (0x0530, "Armenian"), (0x0590, "Hebrew"), (0x0600, "Arabic"),
    (0x0780, None), (0x0900, "Devanagari"), (0x0980, "Bengali"), (0x0A00, "Gurmukhi"), (0x0A80, "Gujarati"), (0x0B00, "Oriya"),
    (0x0B80, "Tamil"), (0x0C00, "Telugu"), (0x0C80, "Kannada"), (0x0D00, "Malayalam"), (0x0D80, "Sinhala"), (0x0E00, "Thai"),
    (0x0E80, "Lao"), (0x0F00, "Tibetan"), (0x1000, "Myanmar"), (0x10A0, "Georgian"), (0x1100, "Hangul"), (0x1200, "Ethiopic"),
    (0x1400, None), (0x1E00, "Latin"), (0x1F00, "Greek"), (0x2000, None), (0x2C60, "Latin"), (0x2C80, None), (0x3040, "Kana"),
    (0x3100, None), (0x3400, "Han"), (0xA000, None), (0xAC00, "Hangul"), (0xD7B0, None), (0xF900, "Han"), (0xFB00, "Latin"),
    (0xFB1D, "Hebrew"), (0xFB50, "Arabic"), (0xFE00, None), (0xFE70, "Arabic"), (0xFF00, None), (0x20000, "Han"), (0x32000, None),
]
STARTS = [start for start, _ in SCRIPTS]
FIRST_NOT_LATIN = chr(SCRIPTS[1][0])


def script_of(char: str) -> str | None:
    return SCRIPTS[bisect.bisect(STARTS, ord(char)) - 1][1]


def script_of_word(word: str) -> str | None:
    """The script of most letters, of the first letter in a tie."""
    if max(word) < FIRST_NOT_LATIN:
        return "Latin"
    return Counter(map(script_of, word)).most_common(1)[0][0]


def grams(word: str) -> list[str]:
    """Runs of one to three letters with the word's ends marked, and the whole word if it is short."""
    marked = f"^{word}$"
    found = [marked] if len(word) <= 12 else []
    return found + [*word] + [marked[i : i + n] for n in (2, 3) for i in range(len(marked) - n + 1)]


@dataclass
class Model:
    languages: list[str]
    places: dict[str, int]
    scores: np.ndarray
    scripts: dict[str | None, list[int]]
    name: str

    def word_row(self, word: str) -> bytes:
        """Packed: a score for each language, the best at 0, and the number of letters."""
        word = word.lower()
        letters = len(word) if word.isalpha() else sum(map(str.isalpha, word))
        row = np.zeros(len(self.languages) + 1, np.float32)
        if letters and (candidates := self.scripts.get(script_of_word(word), [])):
            place = self.places.get
            rows = [x for x in map(place, grams(word)) if x is not None]
            scores = row[:-1]
            if rows:
                scores += np.add.reduce(self.scores.take(rows, axis=0))
                scores *= letters / (3 * letters + 2)
            if len(candidates) < len(self.languages):
                scores -= scores[candidates].max()
                np.minimum(scores, 0, out=scores)
                foreign = np.ones(len(self.languages), bool)
                foreign[candidates] = False
                scores[foreign] = scores.min() - FOREIGN
            else:
                scores -= scores.max()
        row[-1] = letters
        return row.tobytes()


def rows_of(model: Model) -> Memo:
    """The rows of words under a model; a worker keeps them from task to task."""
    return kept_by_worker(f"language {model.name}", "rows", lambda: Memo(model.word_row))


def best_path(scores: np.ndarray, penalty: float = SWITCH_PENALTY) -> np.ndarray:
    """Labels of the words on the best path; ``scores``: words by languages. Ties go to the language that comes first,
    and to staying."""
    sums = scores.sum(axis=0, dtype=np.float64)
    main = int(sums.argmax())
    gain = np.cumsum(scores - scores[:, main : main + 1], axis=0, dtype=np.float64)
    gain = np.vstack([np.zeros(scores.shape[1]), gain])
    if 2 * (gain - np.minimum.accumulate(gain, axis=0)).max() < penalty:
        return np.full(len(scores), main, np.int32)
    score, tops, switched = scores[0].tolist(), [0], [()]
    for row in scores[1:].tolist():
        top = score.index(max(score))
        reached = score[top] - penalty
        tops.append(top)
        switched.append([x < reached for x in score])
        score = [(reached if x < reached else x) + y for x, y in zip(score, row, strict=True)]
    labels = np.empty(len(scores), np.int32)
    label = score.index(max(score))
    for at in range(len(scores) - 1, -1, -1):
        labels[at] = label
        if at and switched[at][label]:
            label = tops[at]
    return labels


def fit(docs: DataFrame, labelled: Column, sample_docs: int = SAMPLE_DOCS, features: int = FEATURES, languages: int = LANGUAGES) -> Model:
    """Fits on rows for which ``labelled`` holds, with a text and a language: about ``sample_docs`` whole texts per
    language, chosen by a hash of the id. What comes to the driver is bounded by ``features`` and ``languages``."""
    small_batches(docs.sparkSession)
    rows = docs.where(labelled & F.col("text").isNotNull() & F.col("lang").isNotNull())
    sizes = rows.groupBy("lang").agg(F.count("*").alias("_docs"))
    top = [(row["lang"], row["_docs"]) for row in sizes.orderBy(F.desc("_docs"), "lang").limit(languages).collect()]
    top.sort()
    share = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    wanted = F.lit(False)
    for lang, size in top:
        wanted = wanted | ((F.col("lang") == lang) & (share < sample_docs / size))
    kept = rows.where(wanted).select("lang", "text")

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        alone("language")
        words: dict[str, Counter] = {}
        size = 0
        for batch in batches:
            for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist(), strict=True):
                words.setdefault(lang, Counter()).update(map(str.lower, LETTERS.findall(text)))
            size += batch.num_rows
            if size >= 2000:
                yield packed(words)
                words, size = {}, 0
        yield packed(words)

    def packed(words: dict[str, Counter]) -> pa.RecordBatch:
        found: Counter = Counter()
        for lang, counts in words.items():
            for word, n in counts.items():
                for gram in grams(word):
                    found["g", lang, gram] += n
                found["s", lang, script_of_word(word) or ""] += n * len(word)
        kinds, langs, texts = zip(*found, strict=True) if found else ((), (), ())
        values = [pa.array(x, pa.string()) for x in (kinds, langs, texts)] + [pa.array(found.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(values, ["kind", "lang", "gram", "n"])

    counts = kept.mapInArrow(counted, "kind string, lang string, gram string, n long").groupBy("kind", "lang", "gram").agg(F.sum("n").alias("n"))
    by_gram = counts.groupBy("kind", "gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "n"))).alias("by"), F.sum("n").alias("all"))
    found = by_gram.orderBy(F.desc(F.col("kind") == "s"), F.desc("all"), "gram").limit(features).collect()
    names = [lang for lang, _ in top]
    kept_grams = [row for row in found if row["kind"] == "g"]
    matrix = np.array([[row["by"].get(lang, 0) for lang in names] for row in kept_grams], np.float64).reshape(len(kept_grams), len(names))
    totals = matrix.sum(axis=0) + SMOOTHING * (len(matrix) + 1)
    letters = {row["gram"] or None: [row["by"].get(lang, 0) for lang in names] for row in found if row["kind"] == "s"}
    of_language = np.array([*letters.values()], np.float64).sum(axis=0) if letters else np.zeros(len(names))
    scripts = {script: [i for i, n in enumerate(row) if n and n >= SCRIPT_SHARE * of_language[i]] for script, row in letters.items()}
    places = {row["gram"]: i for i, row in enumerate(kept_grams)}
    return Model(names, places, np.log((matrix + SMOOTHING) / totals).astype(np.float32), scripts, uuid.uuid4().hex)


def spans_of(text: str, labels: np.ndarray, names: list[str]) -> list[dict]:
    """Stretches of words with the same label: character offsets, end exclusive."""
    out: list[dict] = []
    for match, label in zip(LETTERS.finditer(text), labels.tolist(), strict=True):
        if out and out[-1]["lang"] == names[label]:
            out[-1]["end"] = match.end()
        else:
            out.append({"start": match.start(), "end": match.end(), "lang": names[label]})
    return out


SPANS = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("lang", pa.string())]))


def predict(docs: DataFrame, model: Model, penalty: float = SWITCH_PENALTY) -> DataFrame:
    """Adds ``lang_pred``, ``score`` and ``spans`` to the columns of ``docs`` (columns of these names are replaced).

    ``score`` is the share of letters in spans of ``lang_pred``, which is the language with most letters, the first by
    name in a tie. A text that is null or has no letters, or any text if no language was learned: ``und``, score 0, no
    spans. A text with one label has one span over its words. Only ``text`` is read; every row comes back.
    """
    small_batches(docs.sparkSession)
    names = model.languages
    added = {"lang_pred": "string", "score": "double", "spans": "array<struct<start:int,end:int,lang:string>>"}
    docs = docs.drop(*added)

    def label(text: str | None, rows: Memo) -> tuple[str, float, list[dict]]:
        words = LETTERS.findall(text) if text and names else []
        if not words:
            return UNDETERMINED, 0.0, []
        table = np.frombuffer(b"".join(map(rows.__getitem__, words)), np.float32).reshape(len(words), len(names) + 1)
        letters = table[:, -1].astype(np.float64)
        if not (total := letters.sum()):
            return UNDETERMINED, 0.0, []
        labels = best_path(table[:, :-1], penalty)
        share = np.bincount(labels, letters, len(names))
        first = int(share.argmax())
        if (labels == labels[0]).all():
            begin, end = next(LETTERS.finditer(text)).start(), len(text)
            return names[first], 1.0, [{"start": begin, "end": end, "lang": names[first]}]
        return names[first], float(share[first] / total), spans_of(text, labels, names)

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = rows_of(model)
        for batch in batches:
            found = [label(text, rows) for text in batch["text"].to_pylist()]
            new = [pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64()), pa.array([x[2] for x in found], SPANS)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *new], [*batch.schema.names, *added])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema] + [f"{k} {v}" for k, v in added.items()])
    return docs.mapInArrow(labelled, schema)
