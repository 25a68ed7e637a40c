"""Batch jobs and the registered query catalog."""
