"""Readers, snapshot views and sinks."""
