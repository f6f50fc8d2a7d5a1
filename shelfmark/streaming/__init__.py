"""The review feed as a Structured Streaming query."""
