"""Imports every query module, so that all queries are registered."""

from . import cleaning, features, flagship, models, profiles, resampling, scoring, sources  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
