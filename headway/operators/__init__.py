"""Derived tables and queries as DataFrame functions."""
