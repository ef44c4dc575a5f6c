"""Structured Streaming: the exactly-once file-load ledger."""
