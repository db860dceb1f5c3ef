"""The preprocessing flow clean -> derive -> encode -> select -> split -> scale."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.operators import features as FE
from veritab.session import run_table


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    fitted: DataFrame
    features: list[str]
    metadata: dict


def _class_map(mapping: DataFrame, most: int = 10_000) -> dict:
    """value -> index of a target's classes; a target of more than ``most`` values is refused."""
    rows = mapping.limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"the target has more than {most} classes")
    return {r["value"]: r["index"] for r in rows}


def preprocess(df: DataFrame, target: str, key: Sequence[str], derivation: FE.Derivation | None = None,
               k_best: int = 20, test_size: float = 0.2, seed=42, select_on: str = "all",
               exclude: Sequence[str] = ()) -> Prepared:
    """Default order follows the monitored project (select on all rows, then split);
    ``select_on="train"`` selects on the training rows only (no leak)."""
    clean, _ = FE.clean(df)
    derived = FE.derive(clean, derivation) if derivation else clean
    encoded, mapping = FE.encode_target(derived, target, "target")
    encoded = run_table(encoded)  # every step below reads it: duplicates are dropped once
    from veritab.operators.profile import numeric_names
    candidates = [c for c in numeric_names(encoded, exclude=[*key, "target", *exclude])]
    split = FE.stratified_split(encoded, "target", key, test_size, seed)
    basis = split.where(F.col("split") == "train") if select_on == "train" else encoded
    _, chosen = FE.select_k_best(basis, candidates, "target", k_best)
    keep = [*key, *chosen, "target", "split"]
    split = run_table(split.select(*keep))
    train = split.where(F.col("split") == "train").drop("split")
    test = split.where(F.col("split") == "test").drop("split")
    train_s, test_s, fitted = FE.standard_scale(train, test, chosen)
    meta = {"feature_names": chosen, "n_features": len(chosen), "test_size": test_size, "seed": seed,
            "target_mapping": _class_map(mapping)}
    return Prepared(train_s, test_s, fitted, chosen, meta)
