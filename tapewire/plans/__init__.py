"""Registered queries, one module per family."""

from __future__ import annotations

from importlib import import_module

FAMILIES = ("bars", "portfolios", "news", "pages", "vectors", "tabular", "learning", "streams")


def load_all():
    """Import every family, which registers its queries, and return the registry."""
    for family in FAMILIES:
        import_module(f"tapewire.plans.{family}")
    return import_module("tapewire.plans.registry")
