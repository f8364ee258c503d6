"""Incremental refresh of derived tables."""
