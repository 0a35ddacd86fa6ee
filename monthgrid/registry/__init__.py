"""Named queries over the star-schema tables, each with its SQL twin where one exists."""

from __future__ import annotations

import importlib

AREAS = ("medallion", "features", "quality", "evaluate", "sources", "forecasts")


def load():
    """(queries, oracle SQL) of all areas."""
    for area in AREAS:
        importlib.import_module(f"monthgrid.registry.{area}")
    from monthgrid.registry.core import ORACLES, QUERIES

    return QUERIES, ORACLES
