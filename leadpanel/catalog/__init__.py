"""Registered queries: every operator applied to the given tables."""

from importlib import import_module

MODULES = ["permits", "expressions", "spatial", "tables", "scoring", "timeline", "serving", "streams", "modelling"]


def load() -> None:
    """Import every module that registers queries."""
    for name in MODULES:
        import_module(f"leadpanel.catalog.{name}")
