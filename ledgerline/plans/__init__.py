"""Plans: the table DAG (`pipeline`), oracle SQL and the query registry."""

from __future__ import annotations

import importlib

QUERY_MODULES = ["q_core", "q_exhibits", "q_archive", "q_console", "q_quality", "q_sources", "q_ext", "q_defaults", "q_versions", "q_scale"]


def load_all():
    from ledgerline.plans.registry import REGISTRY
    for m in QUERY_MODULES:
        importlib.import_module(f"ledgerline.plans.{m}")
    return REGISTRY
