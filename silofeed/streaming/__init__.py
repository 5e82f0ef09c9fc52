"""Structured Streaming jobs."""

from .ingest import ingest_stream, land_changes, read_landed, read_stream, write_stream

__all__ = ["ingest_stream", "land_changes", "read_landed", "read_stream", "write_stream"]
