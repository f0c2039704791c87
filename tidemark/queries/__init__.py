"""Registered queries over the driver's tables, each with its oracle SQL where SQL can say it."""

from .registry import ORACLES, QUERIES
from . import delivery, gold, increments, ingest, quality, silver  # noqa: E402,F401 - fill the registry

__all__ = ["ORACLES", "QUERIES"]
