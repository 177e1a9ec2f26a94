"""Structured Streaming forms of ingestion, stages and daily summaries."""
