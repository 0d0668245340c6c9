"""Landed feeds, stored tables, and tables mapped from the test data."""
