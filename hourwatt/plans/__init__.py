"""Ordered runs over tables, and the registry of named queries."""
