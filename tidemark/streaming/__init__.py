"""The same operators on unbounded input, with Structured Streaming."""
