"""Structured Streaming: exactly-once incremental landing ingest (``incremental``)."""
