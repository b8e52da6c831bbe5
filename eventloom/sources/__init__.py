"""Feeds, keyed tables and sinks."""
