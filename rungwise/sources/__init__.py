"""Scans, sinks and saved models."""
