"""Imports every family, so the registry is complete."""

from ledgerspan.catalog import (  # noqa: F401
    analytics,
    business,
    curated,
    relations,
    rules,
    scalars,
    sources,
)
from ledgerspan.catalog.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]
