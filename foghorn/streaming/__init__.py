"""Structured Streaming forms of the append, volume and enrichment plans."""
