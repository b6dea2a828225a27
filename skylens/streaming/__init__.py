"""Structured Streaming: the native state-vector chain and the finalising epoch processor."""
