"""Structured Streaming: message ingest and derived-table refresh."""
