"""Structured Streaming glue: running queries, stateful per-user handlers,
progress reports."""
