"""Readers and writers: log archives, compressed events, text and table sinks."""
