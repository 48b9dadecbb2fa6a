"""Scans, landing jobs and sinks."""
