"""Keyed event-stream analytics on Spark: one set of DataFrame operators for tables and live feeds."""
