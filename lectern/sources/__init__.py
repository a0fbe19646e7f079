"""Readers, the node store and sinks."""
