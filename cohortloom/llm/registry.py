"""Collects the queries and oracle SQL of this subpackage."""

from __future__ import annotations

from importlib import import_module

MODULES = ["consensus_queries", "canonical_queries", "pairs_queries", "leakage_queries", "mixing_queries", "stuffing_queries"]


def _collect(attribute: str) -> dict:
    out: dict = {}
    for name in MODULES:
        out |= getattr(import_module(f"{__package__}.{name}"), attribute, {})
    return out


def queries() -> dict:
    return _collect("QUERIES")


def oracle_sql() -> dict:
    return _collect("ORACLE_SQL")
