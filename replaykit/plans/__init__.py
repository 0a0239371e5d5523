"""Whole jobs: initial load, replay of a date range, applied recovery plan, marts."""
