"""Batch (and batch-or-stream) operators, each a DataFrame -> DataFrame."""
