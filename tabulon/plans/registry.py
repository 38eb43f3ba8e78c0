"""Query name → (Spark callable, DuckDB oracle). ``__spark_entry__`` re-exports this."""

from __future__ import annotations

import importlib

from tabulon.plans.base import Query

FAMILIES = ("q_survey", "q_profile", "q_stats", "q_features", "q_evaluate", "q_codebook", "q_sources", "q_explain", "q_models", "q_requests", "q_sections")


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    for fam in FAMILIES:
        mod = importlib.import_module(f"tabulon.plans.{fam}")
        for q in mod.QUERIES:
            if q.name in out:
                raise ValueError(f"duplicate query name {q.name}")
            out[q.name] = q
    return out
