"""Incremental processing of newly landed files."""
