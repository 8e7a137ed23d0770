"""Rollup definitions and how stored rollups are refreshed and read."""
