"""Feeds: readers, sinks and the test projection."""
