"""Column-level building blocks: instants, bucket widths, guarded arithmetic."""
