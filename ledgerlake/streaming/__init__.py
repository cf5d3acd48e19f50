"""Incremental (stream-static) enrichment."""
