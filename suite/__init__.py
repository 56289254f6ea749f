"""Registered queries over the driver's tables, each with the SQL that must give the same rows."""

from importlib import import_module

MODULES = ["sources", "filters", "columns", "joins", "places", "groups", "models", "price_models", "texts", "kpis", "tables"]


def load() -> None:
    for name in MODULES:
        import_module(f"suite.{name}")
