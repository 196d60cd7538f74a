"""Idempotency header and dedup keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.functions.text import has_text, key_text, last_header


def idempotency_header(headers: Column) -> Column:
    return last_header(headers, S.IDEMPOTENCY_HEADER)


def offset_key(topic: Column, partition: Column, offset: Column) -> Column:
    return key_text(S.OFFSET_KEY_PREFIX, topic, partition, offset)


def idempotency_key(header: Column) -> Column:
    return key_text(S.IDEMPOTENCY_KEY_PREFIX, header)


def dedup_key(topic: Column, partition: Column, offset: Column, header: Column) -> Column:
    """The one key that decides whether a delivery is a duplicate.

    A delivery is a duplicate when its offset or its idempotency header was accepted before. Copies
    of one offset carry the same headers, and an accepted row marks both keys at once, so a live
    offset key implies a live header key: the header alone decides where there is one, the offset
    where there is none. One key means one shuffle.
    """
    key = F.when(has_text(header), idempotency_key(header)).otherwise(
        offset_key(topic, partition, offset)
    )
    # never null, and said so: else joins on the key would filter on it, computing it once more
    return F.coalesce(key, F.lit(""))
