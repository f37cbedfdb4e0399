"""Importing this module registers every query."""

from stocktake.plans import (  # noqa: F401
    basics,
    documents,
    quality,
    ranking,
    sales,
    storage,
    streams,
    warehouse,
)
from stocktake.plans.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
