"""Registered queries: each operator over whole test tables, with its SQL twin."""

from registry.core import QUERIES, SQL

from registry import (  # noqa: F401  (importing registers)
    aggregate_queries,
    ingest_queries,
    indicator_queries,
    latest_queries,
    lifecycle_queries,
    quality_queries,
    read_queries,
    rollup_queries,
    stream_queries,
)

__all__ = ["QUERIES", "SQL"]
