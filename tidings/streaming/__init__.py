"""The incremental source as a Structured Streaming job."""
