"""Structured Streaming ingestion of the landed feeds (schedule payloads, observed-flight arrays)."""
