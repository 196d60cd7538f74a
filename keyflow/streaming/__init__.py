"""Structured Streaming: keyed TTL state and the micro-batch pipeline."""
