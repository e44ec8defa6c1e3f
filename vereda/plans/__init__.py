"""Layered models, the read functions and the registered workload."""
