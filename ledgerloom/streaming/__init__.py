"""Incremental ingestion with Structured Streaming."""

from ledgerloom.streaming.bronze import ingest_new_runs
from ledgerloom.streaming.windows import EventWindows

__all__ = ["EventWindows", "ingest_new_runs"]
