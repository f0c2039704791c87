"""Incremental loads as available-now file streams."""
