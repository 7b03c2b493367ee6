"""Readers and writers: the case view, raw feeds, the feature store."""
