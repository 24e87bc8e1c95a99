"""The registered queries and their checks."""

from courtside.registry import features, loads, points, profiling, rosters, statistics  # noqa: F401
from courtside.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
