"""Registered queries over the test tables, each with an equivalent SQL where SQL can express it."""

from catalog.registry import ORACLES, QUERIES
from catalog import charts, evaluation, feature_building, models, place_effects, profiling, rate_tables, sampling, tables  # noqa: F401

__all__ = ["ORACLES", "QUERIES"]
