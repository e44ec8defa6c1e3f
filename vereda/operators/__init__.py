"""Ordered windows, ranks, the isolation forest and quality checks."""
