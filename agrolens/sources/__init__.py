"""Readers, HTML table extraction, page batching and sinks."""
