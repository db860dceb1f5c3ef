"""Column roles given to every operator (numeric, categorical, target, prediction, score, key)."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql.types import NumericType


@dataclass(frozen=True)
class Roles:
    numeric: tuple[str, ...] = ()
    categorical: tuple[str, ...] = ()
    target: str | None = None
    prediction: str | None = None
    score: str | None = None
    key: tuple[str, ...] = ()

    @property
    def features(self) -> tuple[str, ...]:
        return tuple(self.numeric) + tuple(self.categorical)

    @property
    def required(self) -> tuple[str, ...]:
        extra = [c for c in (self.target, self.prediction, self.score) if c]
        return self.features + tuple(extra)

    def with_(self, **kw) -> "Roles":
        return replace(self, **{k: tuple(v) if isinstance(v, list) else v for k, v in kw.items()})

    @staticmethod
    def infer(df: DataFrame, target: str | None = None, key: tuple[str, ...] = ()) -> "Roles":
        """Numeric columns by type, everything else categorical; target and key excluded."""
        skip = set(key) | ({target} if target else set())
        num, cat = [], []
        for f in df.schema.fields:
            if f.name in skip:
                continue
            (num if isinstance(f.dataType, NumericType) else cat).append(f.name)
        return Roles(numeric=tuple(num), categorical=tuple(cat), target=target, key=tuple(key))


# The monitored lineitem roles used by the checked queries (FIXTURES.md section 2).
LINEITEM = Roles(
    numeric=("l_quantity", "l_extendedprice", "l_discount", "l_tax"),
    categorical=("l_returnflag", "l_linestatus"),
    target="target",
    key=("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"),
)
