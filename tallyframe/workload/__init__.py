"""Catalogue of registered queries: one Spark builder and (where SQL can say it) one
DuckDB oracle per operator key of the blueprint."""

from __future__ import annotations

import importlib

_MODULES = ["q_charts", "q_text", "q_frames", "q_registry", "q_template", "q_report", "q_io"]


def catalogue():
    queries, oracles = {}, {}
    for m in _MODULES:
        mod = importlib.import_module(f"{__name__}.{m}")
        queries.update(mod.Q)
        oracles.update(mod.SQL)
    from .tables import with_sig_rounding
    return queries, {k: with_sig_rounding(v) for k, v in oracles.items()}
