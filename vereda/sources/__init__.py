"""Payload documents, JSON line files and lake tables as DataFrames."""
