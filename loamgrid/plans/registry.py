"""All queries of the library by name, with their SQL twins."""

from __future__ import annotations

from . import corpus_queries, gate_queries, nested_queries, page_queries, promotion_queries, relational_queries, stream_queries, surface_queries  # noqa: F401  they register themselves
from .base import ORACLES, QUERIES

FLAGSHIP = "copy_band_pricing"

__all__ = ["FLAGSHIP", "ORACLES", "QUERIES"]
