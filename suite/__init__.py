"""The registered queries over the test tables and the plain SQL each must agree with."""

from importlib import import_module

MODULES = ("reports", "kpis", "scans", "exprs", "streams")


def load_all():
    """Import every module of queries once and return the registry."""
    for name in MODULES:
        import_module(f"suite.{name}")
    return import_module("suite.registry")
