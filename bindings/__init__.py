"""Queries over the test tables, each with its SQL counterpart where SQL can say it."""

from __future__ import annotations

from importlib import import_module

MODULES = ("post_queries", "select_queries", "user_queries", "source_queries", "run_queries")


def load_all():
    """Imports every query module and returns the filled registry."""
    for name in MODULES:
        import_module(f"bindings.{name}")
    return import_module("bindings.registry")
