"""Live path on Structured Streaming."""
