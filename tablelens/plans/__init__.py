from .analyze import analyze, describe
from .registry import ORACLES, QUERIES

from . import aggregates, calendar, keyed, labels, quality, reports, rows  # noqa: F401  (fill the registry)

__all__ = ["ORACLES", "QUERIES", "analyze", "describe"]
