"""Registered queries and their ANSI-SQL oracles."""

from importlib import import_module

MODULES = ["summaries", "cleaning", "orders", "income", "riders", "dispatch", "commission", "loads", "streams", "commits"]


def load_all():
    """(queries, oracles) of every module."""
    for name in MODULES:
        import_module(f"tillworks.plans.{name}")
    from tillworks.plans.registry import ORACLES, QUERIES

    return QUERIES, ORACLES
