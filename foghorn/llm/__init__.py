"""Operators for building training corpora: cleaning, deduplication, formatting, encoding, packing.

Nothing outside this subpackage imports it. Every operator takes and returns DataFrames and keeps
its own general interface; ``foghorn.llm.queries`` derives the registered queries from them.
"""
