"""Structured Streaming ingestion of landed pulls."""
