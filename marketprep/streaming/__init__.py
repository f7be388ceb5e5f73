"""Structured Streaming ingestion of the landing folders."""
