"""Incremental forms of the batch operators for files that keep arriving."""
