"""Readers, ingest steps and sinks."""
