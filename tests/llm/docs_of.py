"""Small document tables for the tests."""

EXTRA = "doc_id long, text string, lang string, source string, n_chars long"
#: Nulls, empty and blank texts, repeated rows and ids, a long word, and letters of several scripts.
ODD = [
    (1, "The cat sat on the mat and the dog ran off to the old mill by the river today."),
    (2, None),
    (3, ""),
    (4, " \n\t "),
    (None, "A text without an id that still has some words in it."),
    (None, None),
    (5, "same id"),
    (5, "same id"),
    (5, "same id, other text"),
    (6, "x" * 5000),
    (7, "naïve café — Ünïcödé 日本語 🙂 ́ <|endoftext|> don't  stop"),
    (-8, "Negative ids are ids."),
]


def docs_of(spark, rows):
    return spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows], EXTRA)


def clashing(frame):
    """More columns, named like those the operators work with."""
    from pyspark.sql import functions as F

    return frame.withColumns({name: F.lit("x") for name in ("key", "id", "node", "block", "ids", "tokens", "score", "hash", "_row", "kept")})
