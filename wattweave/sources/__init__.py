"""Readers, sinks and SQL views."""
