"""Completion messages as a stream."""
