"""Incremental loads from a stream of changed rows."""
