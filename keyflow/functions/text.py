"""Text, header and instant functions over columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ISO_INSTANT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"


def has_text(value: Column) -> Column:
    """True when the value holds at least one non-whitespace character; never null."""
    return F.coalesce(value.rlike(r"\P{javaWhitespace}"), F.lit(False))


def key_text(prefix: str, *parts: Column) -> Column:
    """``prefix`` followed by the parts joined with colons; null if any part is null."""
    pieces = [parts[0].cast("string")]
    for part in parts[1:]:
        pieces += [F.lit(":"), part.cast("string")]
    return F.concat(F.lit(prefix), *pieces)


def last_header(headers: Column, name: str) -> Column:
    """UTF-8 text of the last header of that name; null when it is absent or its value is null."""
    named = F.filter(headers, lambda header: header["key"] == F.lit(name))
    return F.make_valid_utf8(F.try_element_at(named, F.lit(-1))["value"].cast("string"))


def header_names(headers: Column) -> Column:
    """Header names in order, repeats included; an empty array when there are no headers."""
    names = F.transform(headers, lambda header: header["key"])
    return F.coalesce(names, F.array().cast("array<string>"))


def set_headers(headers: Column, values: dict[str, Column]) -> Column:
    """Replace every header of the given names by one each at the end, in the order given.

    A null value leaves its name as it was; null headers stay null.
    """
    names = F.array(*[F.when(value.isNotNull(), F.lit(name)) for name, value in values.items()])
    added = F.array(
        *[
            F.struct(F.lit(name).alias("key"), value.cast("binary").alias("value"))
            for name, value in values.items()
        ]
    )
    kept = F.filter(
        headers,
        lambda header: ~F.coalesce(F.array_contains(names, header["key"]), F.lit(False)),
    )
    return F.concat(kept, F.filter(added, lambda header: header["value"].isNotNull()))


def set_header(headers: Column, name: str, value: Column) -> Column:
    return set_headers(headers, {name: value})


def no_headers() -> Column:
    return F.array().cast("array<struct<key: string, value: binary>>")


def iso_instant(instant: Column) -> Column:
    """ISO-8601 text in UTC with none, three or six digits as needed, whatever the session time zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    in_utc = F.timestamp_add("MICROSECOND", F.unix_micros(instant), epoch)
    whole = F.regexp_replace(F.date_format(in_utc, ISO_INSTANT), r"\.000000Z$", "Z")
    return F.regexp_replace(whole, r"(\.\d{3})000Z$", "$1Z")
