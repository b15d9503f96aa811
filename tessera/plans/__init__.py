"""Whole pipelines, the stand-in entity tables, and the registered queries."""
