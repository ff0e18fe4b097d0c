"""Incremental ingestion of landed result pages (Structured Streaming)."""
