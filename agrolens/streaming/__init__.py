"""Structured Streaming: incremental ingestion of page batches."""
