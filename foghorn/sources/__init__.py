"""Readers, landed-payload flatteners and sinks."""
