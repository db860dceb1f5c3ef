"""RBF support vector machine with a certificate (M3).

The kernel is ``exp(-gamma |x - y|^2)`` through Nystroem features of ``landmarks`` training rows (those with the
smallest key hash, each text of numbers once): ``phi(x) = K_mm^(-1/2) k_m(x)``. With no more training rows than landmarks
this is the exact kernel; else the fit reports ``kernel_residual``, the mean of ``1 - |phi(x)|^2``, the part of the
kernel's diagonal that the landmarks do not reach.

The machine minimises ``|w|^2 / 2 + C * sum(weight * hinge)`` with a free intercept by a primal-dual interior-point
method. A row's dual state (multiplier and two slacks) depends on the steps so far only, so tasks replay it from the
list of steps instead of keeping it: nothing per row is written between scans, and a lost executor costs its scan only.
One scan sums a matrix of landmarks + 1 rows and the objectives, a second one finds the longest step; about 20
iterations, whatever the number of rows. The fit ends when the duality gap, primal less dual objective, is below
``tolerance`` of the primal one; the gap is part of the model.

Rows with a null label, null array, null or NaN element, or fewer elements than others are not learnt from; such rows
get a null margin. An empty table raises ValueError, one class gives a constant margin.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from veritab.functions.scalar import col_of
from veritab.operators.batched import _summed
from veritab.session import run_table

#: Iterations after which a fit is taken as it is; share of the longest step; share of the mean complementarity aimed at.
MAX_STEPS, BACK, CENTRE = 60, 0.99, 0.1


class Nystroem(NamedTuple):
    """Feature map of an RBF kernel: landmarks (m x d) and K_mm^(-1/2) (m x rank)."""
    landmarks: np.ndarray
    root: np.ndarray
    gamma: float

    def __call__(self, x: np.ndarray) -> np.ndarray:
        d2 = (x * x).sum(1)[:, None] + (self.landmarks * self.landmarks).sum(1)[None] - 2 * x @ self.landmarks.T
        return np.exp(-self.gamma * np.maximum(d2, 0)) @ self.root


def feature_map(landmarks: np.ndarray, gamma: float) -> Nystroem:
    """Map of these landmarks; directions in which they hardly differ are left out."""
    plain = Nystroem(landmarks, np.eye(len(landmarks)), gamma)
    values, vectors = np.linalg.eigh(plain(landmarks))
    kept = values > 1e-10 * values.max()
    return Nystroem(landmarks, vectors[:, kept] / np.sqrt(values[kept]), gamma)


class Step(NamedTuple):
    """One step of all variables: direction of (w, b), aimed complementarity, length."""
    direction: np.ndarray
    mu: float
    length: float


def _replayed(phi: np.ndarray, y: np.ndarray, c: np.ndarray, steps: Sequence[Step]) -> tuple[np.ndarray, ...]:
    """(alpha, s, xi, margin) of rows after ``steps``; phi ends in a column of ones."""
    a, s, xi, f = c / 2, np.ones(len(y)), np.ones(len(y)), np.zeros(len(y))
    if steps:
        along = phi @ np.stack([t.direction for t in steps], axis=1)
        for k, t in enumerate(steps):
            da, ds, dxi = _change(a, s, xi, f, y, c, along[:, k], t.mu)
            a, s, xi, f = a + t.length * da, s + t.length * ds, xi + t.length * dxi, f + t.length * along[:, k]
    return a, s, xi, f


def _change(a, s, xi, f, y, c, along, mu):  # noqa: ANN001, ANN202
    """Newton step of the rows' variables for a step of their margins by ``along``."""
    theta = xi / (c - a) + s / a
    da = (1 - y * f - mu / (c - a) + mu / a - y * along) / theta
    return da, mu / a - s - s / a * da, mu / (c - a) - xi + xi / (c - a) * da


def _read(batch: pa.RecordBatch, width: int) -> tuple[np.ndarray, ...]:
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(len(batch), width)
    return x, batch.column("y").to_numpy(), batch.column("c").to_numpy()


class KernelSVM(NamedTuple):
    """M3: RBF kernel, C = 1, gamma ``1 / (dim * Var(x))`` unless given, class weights from ``weight_col``."""
    array_col: str
    key: tuple[str, ...]
    label: str = "label"
    weight_col: str | None = "weight"
    C: float = 1.0
    gamma: float | None = None
    landmarks: int = 256
    tolerance: float = 1e-6
    seed: int = 42

    def fit(self, df: DataFrame) -> "KernelModel":
        weight = col_of(self.weight_col).cast("double") if self.weight_col and self.weight_col in df.columns else F.lit(1.0)
        x = F.col(self.array_col).cast("array<double>")
        rows = run_table(df.select(x.alias("x"), F.when(col_of(self.label) > 0, 1.0).otherwise(-1.0).alias("y"), (weight * self.C).alias("c"),
                                   F.xxhash64(F.lit(self.seed), *[col_of(k) for k in self.key]).alias("h"), col_of(self.label).alias("l"))
                         .where("x IS NOT NULL AND l IS NOT NULL AND c > 0 AND forall(x, v -> v IS NOT NULL AND NOT isnan(v))").drop("l"))
        width = rows.agg(F.max(F.size("x"))).first()[0]
        rows = rows.where(F.size("x") == F.lit(width))
        n, positive = rows.agg(F.count(F.lit(1)), F.sum((F.col("y") > 0).cast("int"))).first()
        if not n:
            raise ValueError("no rows to learn from")
        gamma = self.gamma
        if gamma is None:
            gamma = 1.0 / (width * (rows.select(F.explode("x").alias("v")).agg(F.var_pop("v")).first()[0] or 1.0))
        # at most ``landmarks`` rows
        marks = rows.groupBy("x").agg(F.min("h").alias("h")).orderBy("h", "x").limit(self.landmarks).select("x").collect()
        phi = feature_map(np.array([r["x"] for r in marks], dtype=np.float64), gamma)
        if positive in (0, n):
            b = np.r_[np.zeros(phi.root.shape[1]), 1.0 if positive else -1.0]
            return KernelModel(phi, b, self.array_col, 0.0, 0.0, 0, _scan(rows, phi, [], width)["residual"] / n, 0)
        steps: list[Step] = []
        w = np.zeros(phi.root.shape[1] + 1)
        while True:
            t = _scan(rows, phi, steps, width)
            v = w[:-1]
            primal = v @ v / 2 + t["hinge"]
            gap = primal - (t["alpha"] - t["dual"] @ t["dual"] / 2)
            whole = abs(t["balance"]) <= 1e-9 * t["alpha"] and np.linalg.norm(t["dual"] - v) <= 1e-6 * (1 + np.linalg.norm(v))
            if (whole and gap <= self.tolerance * max(primal, 1e-12)) or len(steps) == MAX_STEPS:
                return KernelModel(phi, w, self.array_col, primal, gap, int(t["support"]), t["residual"] / n, len(steps))
            mu = CENTRE * t["product"] / (2 * n)
            matrix = t["matrix"] + np.diag(np.r_[np.ones(len(v)), 0.0])
            direction = np.linalg.solve(matrix, t["right0"] + mu * t["right1"] - np.r_[v, 0.0])
            length = min(1.0, BACK * _longest(rows, phi, steps, direction, mu, width))
            steps.append(Step(direction, mu, length))
            w = w + length * direction


def _scan(rows: DataFrame, phi: Nystroem, steps: list[Step], width: int) -> dict:
    """Sums over all rows after ``steps``: the matrix and right sides of the next step (right0 + mu * right1), hinge
    loss, sum of alpha, dual vector, balance, complementarity, rows with alpha above a millionth of c, kernel residual."""
    m = phi.root.shape[1] + 1

    def run(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        x, y, c = _read(batch, width)
        p = phi(x)
        lost = 1 - (p * p).sum(1)
        p = np.hstack([p, np.ones((len(y), 1))])
        a, s, xi, f = _replayed(p, y, c, steps)
        theta = xi / (c - a) + s / a
        matrix = (p / theta[:, None]).T @ p
        # alpha + q / theta, where q = 1 - y f + mu * (1 / alpha - 1 / (c - alpha))
        right0, right1 = (y * (a + (1 - y * f) / theta)) @ p, (y * (1 / a - 1 / (c - a)) / theta) @ p
        own = (y * a) @ p
        yield 0, np.concatenate([matrix.ravel(), right0, right1, own,
                                 [(c * np.maximum(0, 1 - y * f)).sum(), a.sum(), (a * s + (c - a) * xi).sum(), (a > 1e-6 * c).sum(), lost.sum()]])

    v = _summed(rows.select("x", "y", "c"), run, m * m + 3 * m + 5)[0]
    own, tail = v[m * m + 2 * m:m * m + 3 * m], v[m * m + 3 * m:]
    return {"matrix": v[:m * m].reshape(m, m), "right0": v[m * m:m * m + m], "right1": v[m * m + m:m * m + 2 * m], "dual": own[:-1], "balance": own[-1],
            "hinge": tail[0], "alpha": tail[1], "product": tail[2], "support": tail[3], "residual": tail[4]}


def _longest(rows: DataFrame, phi: Nystroem, steps: list[Step], direction: np.ndarray, mu: float, width: int) -> float:
    """Longest step that keeps every row's alpha in (0, c) and slacks above 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least = 1e6
        for batch in batches:
            if len(batch):
                x, y, c = _read(batch, width)
                p = np.hstack([phi(x), np.ones((len(y), 1))])
                a, s, xi, f = _replayed(p, y, c, steps)
                da, ds, dxi = _change(a, s, xi, f, y, c, p @ direction, mu)
                for now, change in ((a, da), (c - a, -da), (s, ds), (xi, dxi)):
                    falls = change < 0
                    if falls.any():
                        least = min(least, (now[falls] / -change[falls]).min())
        yield pa.RecordBatch.from_arrays([pa.array([least])], ["length"])

    return rows.select("x", "y", "c").mapInArrow(run, "length double").agg(F.min("length")).first()[0]


class KernelModel(NamedTuple):
    """Fitted machine. ``gap``: primal less dual objective; ``kernel_residual``: mean part of the kernel's diagonal that
    the landmarks do not reach (0: exact kernel on the training rows)."""
    phi: Nystroem
    weights: np.ndarray
    array_col: str
    objective: float
    gap: float
    support: int
    kernel_residual: float
    iterations: int

    def margin(self) -> Column:
        """Signed distance ``w . phi(x) + b``; null for rows with missing elements."""
        phi, w = self.phi, self.weights

        @pandas_udf("double")
        def run(x: pd.Series) -> pd.Series:
            return pd.Series(phi(np.vstack(x.to_numpy())) @ w[:-1] + w[-1] if len(x) else np.zeros(0))

        x = F.col(self.array_col).cast("array<double>")
        whole = F.coalesce((F.size(x) == self.phi.landmarks.shape[1]) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v)), F.lit(False))
        return F.when(whole, run(F.when(whole, x).otherwise(F.array_repeat(F.lit(0.0), self.phi.landmarks.shape[1]))))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``margin`` and ``prediction`` (null where the margin is null)."""
        return df.withColumn("margin", self.margin()).withColumn("prediction", (F.col("margin") > 0).cast("int"))
