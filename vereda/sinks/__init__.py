"""Partitioned files, topics, tables and reports."""
