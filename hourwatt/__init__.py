"""Hourly energy analytics as Spark jobs."""
