"""Incremental ingestion (Structured Streaming, AvailableNow) and snapshot diffs."""

from strata.streaming.incremental import diff_snapshots, ingest_new_files, process_new_files, row_fingerprint

__all__ = ["diff_snapshots", "ingest_new_files", "process_new_files", "row_fingerprint"]
