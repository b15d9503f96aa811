"""Matching reference records as they arrive."""
