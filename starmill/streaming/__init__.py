"""Runs driven by files as they land."""
