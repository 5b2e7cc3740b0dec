"""Structured Streaming: idempotent ingest, stateful event merging, timeouts."""
