"""Incremental landing ingest with Structured Streaming (``availableNow``)."""

from tessera.streaming.landing_stream import ingest_feed, read_ingested  # noqa: F401
