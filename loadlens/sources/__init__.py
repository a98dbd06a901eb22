"""Readers and writers for delimited files, raw lines and file listings."""
