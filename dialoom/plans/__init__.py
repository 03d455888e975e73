"""Registered queries by area, each with the SQL that gives the same rows."""

from __future__ import annotations

import importlib

AREAS = ("sequences", "chat", "intervals", "aggregates", "quality_checks", "evaluation", "machines", "speakers", "streams", "entities", "annotations", "reports", "texts", "exports", "voices", "repairs", "sections", "voice_chain", "formal_qc")


def load() -> tuple[dict, dict]:
    """All queries and their SQL, by name."""
    from dialoom.plans import base

    for area in AREAS:
        importlib.import_module(f"dialoom.plans.{area}")
    return dict(base.QUERIES), dict(base.SQL)
