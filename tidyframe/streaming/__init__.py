"""Incremental (streaming) ingest of newly arrived files."""

from tidyframe.streaming.ingest import ingest_files, run_incremental

__all__ = ["ingest_files", "run_incremental"]
