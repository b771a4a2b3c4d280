"""Scans, sinks and shared scratch storage."""
