"""Scans, sinks and the contract views derived from the given tables."""
