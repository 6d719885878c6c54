"""Registered queries: each reads the given tables and has, where SQL can say it,
an equivalent statement to compare with."""

from __future__ import annotations

from importlib import import_module

MODULES = ["profiles", "quality_checks", "scores", "summaries", "streams"]


def load():
    """Import all query modules and return the registry."""
    for name in MODULES:
        import_module(f"suite.{name}")
    return import_module("suite.registry")
