"""Named queries, grouped by theme."""

from __future__ import annotations

import importlib

THEMES = ("analytics", "sales", "silver", "feeds", "history", "storage")


def load_all():
    """Import every theme and return the registry they fill."""
    for theme in THEMES:
        importlib.import_module(f"lakeops.plans.{theme}")
    return importlib.import_module("lakeops.plans.registry")
