"""Column expressions: codecs, change-data-capture envelopes, keys and event time."""
