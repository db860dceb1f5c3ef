"""Checked queries: one entry per inventory id, each a Spark callable ``(spark, sf_dir)``
plus, where SQL can express it, an independent DuckDB SQL twin with the same columns."""

from __future__ import annotations

import importlib

from veritab.catalog.base import REGISTRY, Query

_MODULES = ["monitoring", "profiles", "drift", "features", "evaluation", "models", "streams", "tables", "scalars", "reports", "states"]


def load_all() -> dict[str, Query]:
    for m in _MODULES:
        importlib.import_module(f"veritab.catalog.{m}")
    return dict(sorted(REGISTRY.items()))
