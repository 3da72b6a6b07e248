"""Collects the registered queries of all families."""

from __future__ import annotations

import importlib
import pkgutil

import checks

FAMILIES = [m.name for m in pkgutil.iter_modules(checks.__path__) if m.name.startswith("family_")]


def _collect(kind: str) -> dict:
    out: dict = {}
    for name in FAMILIES:
        part = getattr(importlib.import_module(f"checks.{name}"), kind)
        clash = out.keys() & part.keys()
        if clash:
            raise ValueError(f"registered twice: {clash}")
        out.update(part)
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLES")


def flagship(spark, sf_dir):
    from checks.family_search import search_with_metadata

    return search_with_metadata(spark, sf_dir)
