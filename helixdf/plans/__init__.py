"""Named queries: one per operator, each paired with a DuckDB oracle."""

from . import checks, io, joins, ordering, preprocess, records, regions, tagsets, validation, whole  # noqa: F401  (registers queries)
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
