"""Queries over the driver's tables: one per operator, each next to the SQL that must give the same rows."""

from __future__ import annotations

from parcelflow.queries.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]

# Importing a module registers its queries.
from parcelflow.queries import cleaning, evaluation, files, formats, histories, keys, landed, models, panels, periods  # noqa: E402,F401
