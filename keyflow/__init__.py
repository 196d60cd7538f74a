"""keyflow: keyed event ingestion on Spark (validate, dedup, upsert, publish)."""
