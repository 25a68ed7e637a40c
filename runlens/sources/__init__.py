"""Readers: runs, experiments, dimension payloads, and the events-derived fixture."""
