"""Incremental, restartable feeding with Structured Streaming."""
