"""Incremental runs of the batch steps."""
