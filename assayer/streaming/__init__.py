"""Structured Streaming: windows, graded micro-batches, event handling, schema changes."""
