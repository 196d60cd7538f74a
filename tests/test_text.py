import pytest
from conftest import header
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyflow import schemas as S
from keyflow.functions import keys, text

HEADER_ROW = T.StructType([T.StructField("headers", S.HEADERS)])


def values(spark, rows, expression):
    return [r[0] for r in spark.createDataFrame(rows, HEADER_ROW).select(expression).collect()]


def test_has_text(spark):
    cases = {None: False, "": False, "  ": False, "\t\n": False, "\u2003": False, "\u00a0": True, " a ": True}
    frame = spark.createDataFrame([(k, v) for k, v in cases.items()], "value string, want boolean")
    for row in frame.select("value", "want", text.has_text(F.col("value")).alias("got")).collect():
        assert row["got"] is row["want"], repr(row["value"])


@pytest.mark.parametrize(
    "headers, want",
    [
        (None, None),
        ([], None),
        ([header("other", "x")], None),
        ([header("k", "first"), header("k", "last")], "last"),
        ([header("k", "first"), header("k", None)], None),
        ([header("k", " ")], " "),
        ([header("k", b"\xffA")], "\ufffdA"),
    ],
)
def test_last_header(spark, headers, want):
    assert values(spark, [(headers,)], text.last_header(F.col("headers"), "k")) == [want]


def test_header_names_keep_order_and_repeats(spark):
    rows = [([header("b", "1"), header("a", "2"), header("b", "3")],), (None,)]
    assert values(spark, rows, text.header_names(F.col("headers"))) == [["b", "a", "b"], []]


def test_set_header_replaces_all_and_appends(spark):
    rows = [([header("k", "1"), header("x", "2"), header("k", "3")],), ([],), (None,)]
    edited = text.set_header(F.col("headers"), "k", F.lit("new"))
    got = [None if h is None else [(r.key, bytes(r.value)) for r in h] for h in values(spark, rows, edited)]
    assert got == [[("x", b"2"), ("k", b"new")], [("k", b"new")], None]


def test_set_header_with_null_value_changes_nothing(spark):
    rows = [([header("k", "1"), header("x", "2")],)]
    edited = text.set_header(F.col("headers"), "k", F.lit(None).cast("string"))
    assert [[r.key for r in h] for h in values(spark, rows, edited)] == [["k", "x"]]


def test_iso_instant_is_utc_in_any_session_zone(spark):
    instant = F.timestamp_micros(F.lit(1704067207179575))
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        got = spark.range(1).select(text.iso_instant(instant)).first()[0]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == "2024-01-01T00:00:07.179575Z"


def test_dedup_keys(spark):
    rows = [("in", 1, 7, "biz-1"), ("in", 1, 8, None), ("in", 1, 9, " ")]
    frame = spark.createDataFrame(rows, "topic string, partition int, offset bigint, header string")
    key = keys.dedup_key(*[F.col(name) for name in frame.columns])
    assert [r[0] for r in frame.select(key).collect()] == [
        "dedup:idemp:biz-1",
        "dedup:offset:in:1:8",
        "dedup:offset:in:1:9",
    ]
