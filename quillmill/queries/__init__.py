"""Catalogue of the engine's own queries and their DuckDB oracles."""

from quillmill.queries import content, extraction, mapping, matching, pricing, reports  # noqa: F401
from quillmill.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
