"""One outcome row per delivery."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from keyflow import schemas as S
from keyflow.operators.classify import failed_rows, marked_outcome, valid_rows, with_dedup_key
from keyflow.operators.dedup import ttl_dedup


def outcome_columns(rows: DataFrame, batch_id: int) -> DataFrame:
    return rows.withColumn("batch_id", F.lit(batch_id).cast("bigint")).select(*S.OUTCOME.names)


def build_outcomes(
    envelopes: DataFrame,
    ttl: str = S.DEDUP_TTL,
    seen: DataFrame | None = None,
    batch_id: int = 0,
    **limits: int,
) -> DataFrame:
    """Classify a log: null and invalid payloads fail, then duplicates are skipped, the rest processed.

    Failed rows never reach the dedup shuffle. The payload travels along; a reader of few columns
    prunes it from the shuffle.
    """
    keyed = with_dedup_key(envelopes)
    marked = marked_outcome(ttl_dedup(valid_rows(keyed), ttl, seen, **limits))
    failed = failed_rows(keyed)
    return outcome_columns(marked, batch_id).unionByName(outcome_columns(failed, batch_id))
