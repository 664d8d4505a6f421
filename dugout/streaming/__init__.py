"""Incremental refresh, as batches by load and as micro-batches of landed files."""
