"""Registered queries over the provided tables, each with its SQL twin where one exists."""

from __future__ import annotations

from foghorn.catalog.base import ORACLES, QUERIES
from foghorn.catalog import (  # noqa: F401
    file_tables,
    matching_tables,
    rollup_tables,
    sample_tables,
    scoring,
    text_tables,
)

__all__ = ["ORACLES", "QUERIES"]
