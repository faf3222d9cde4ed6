"""Queries over the test tables, each with the SQL that must give the same rows."""

from importlib import import_module

MODULES = ("functions", "relational", "sources", "merges", "views", "loads")


def load_all() -> None:
    """Register every query."""
    for name in MODULES:
        import_module(f"spendloom.checks.{name}")
