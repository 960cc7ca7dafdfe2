"""Structured Streaming entry points."""

from .ingest import stream_ingest  # noqa: F401
