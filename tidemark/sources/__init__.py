"""Stored tables, ingest, and projections onto the record schema."""
