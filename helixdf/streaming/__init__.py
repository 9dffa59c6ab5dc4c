"""Structured Streaming entry points."""

from .sam_stream import start_ingest, stream_primary_reads, stream_reads  # noqa: F401
