"""File-stream ingest with Structured Streaming."""
