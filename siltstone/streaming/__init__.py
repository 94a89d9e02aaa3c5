"""Structured Streaming versions of the parts that keep state between runs."""
