"""Registered queries with their comparing SQL."""

from __future__ import annotations

from importlib import import_module

AREAS = ("cleaning", "features", "wide_levels", "profiling", "monitoring", "forecasting", "learning")


def all_checks():
    from demandframe.checks.registry import CHECKS

    for area in AREAS:
        import_module(f"demandframe.checks.{area}")
    return dict(CHECKS)
