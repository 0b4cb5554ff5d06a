"""Incremental ingestion."""

from habispark.streaming.certificates import ingest_new_certificates

__all__ = ["ingest_new_certificates"]
