"""Readers: test-table adapters, committed streaming outputs, completed runs, raw files."""
