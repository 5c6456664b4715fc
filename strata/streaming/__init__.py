"""Structured Streaming entry points (same transformations as the batch jobs)."""
