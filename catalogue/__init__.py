"""Runnable queries over the test tables, each with an independent SQL twin where SQL can say it."""

from __future__ import annotations

import importlib

MODULES = ("scans", "scalars", "predicates", "relational", "products", "streams", "daily")


def load_all() -> None:
    """Imports every query module, which registers its queries."""
    importlib.import_module("catalogue.models_sql")
    for name in MODULES:
        importlib.import_module(f"catalogue.{name}")
