"""Whole jobs, from landed files to published tables."""

from habispark.plans.jobs import (
    build_and_publish,
    coverage_report,
    ingest_certificates,
    ingest_communes,
    ingest_sales,
    publish_results,
)

__all__ = [
    "build_and_publish",
    "coverage_report",
    "ingest_certificates",
    "ingest_communes",
    "ingest_sales",
    "publish_results",
]
