"""Operators for large training-text pipelines.

Nothing outside this subpackage imports it.  Each operator is a function from
DataFrames to DataFrames; ``queries.py`` registers one query per operator.
"""
