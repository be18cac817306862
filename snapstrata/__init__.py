"""Layered analytics over periodic, cumulative statistics snapshots, on Spark."""

__version__ = "0.1.0"
