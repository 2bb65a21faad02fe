"""Structured Streaming jobs (incremental file ingest)."""

from .ingest import ingest_new_files, stream_feed

__all__ = ["ingest_new_files", "stream_feed"]
