"""Queries of this subpackage and their SQL."""

from __future__ import annotations

import importlib

_MODULES = ["ngram_join", "url_filter", "token_count", "sharding", "suffix_dedup", "quality_rank", "merkle", "decontaminate",
            "language", "packing", "phrases", "hard_negatives", "private_data"]


def queries() -> dict:
    found = {}
    for name in _MODULES:
        module = importlib.import_module(f"{__package__}.{name}")
        found |= {k: v for k, v in vars(module).items() if k.startswith("op") and k[2].isdigit() and callable(v)}
    return found


def oracle_sql() -> dict:
    found, names = {}, queries()
    for name in _MODULES:
        for k, v in vars(importlib.import_module(f"{__package__}.{name}")).items():
            if k.startswith("OP") and k.endswith("_SQL"):
                found |= {n: v for n in names if n.startswith(k[:-4].lower() + "_")}
    return found
