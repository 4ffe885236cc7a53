"""Whole jobs, from topic to result."""
