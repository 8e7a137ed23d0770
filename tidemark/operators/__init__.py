"""DataFrame-to-DataFrame operators over records, ticks and bars."""
