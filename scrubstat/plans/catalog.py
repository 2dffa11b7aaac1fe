"""All registered queries: name -> (spark_fn(spark, sf_dir) -> DataFrame, oracle SQL or None)."""

from __future__ import annotations

import importlib

_MODULES = ["q_dashboard", "q_clean", "q_text", "q_convert", "q_profile", "q_distribution",
            "q_stat", "q_dedupe", "q_enrich", "q_files", "q_streaming", "q_edge"]


def registry() -> dict:
    out: dict = {}
    for m in _MODULES:
        out.update(importlib.import_module(f"{__package__}.{m}").Q)
    return out
