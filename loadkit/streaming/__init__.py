"""Structured Streaming: file pipes, row streams, change streams, latency."""
