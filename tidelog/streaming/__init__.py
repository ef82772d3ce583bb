"""Structured Streaming counterparts of the batch operators."""
