"""Structured Streaming entry points (report files ingested as they arrive)."""
