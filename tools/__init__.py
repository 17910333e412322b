"""Checking and documentation tools (oracle comparison, coverage, plans)."""
