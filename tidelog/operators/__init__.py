"""Operators over log tables: DataFrame in, DataFrame out, always lazy."""
