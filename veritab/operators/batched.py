"""Many penalised logistic fits in one pass.

Every fit minimises, over its own rows,

    sum(w * logloss) / sum(w) + lam * ((1 - alpha) / 2 * |b|^2 + alpha * |b|_1)

with an unpenalised intercept. All fits take their steps together: one scan of the table gives the
gradient and the Hessian of every fit that has not ended (each task sums its rows, the sums of a fit are
added by a grouped aggregate), then each fit solves its small quadratic model by coordinate descent
with the soft threshold of its L1 term (a proximal Newton step; the plain Newton step without one). A step
that does not lower the objective is halved, seen by the next scan. The number of scans is that of the
slowest fit, whatever the number of fits; what comes to the driver is one matrix of coefficients per fit.

Rows with a null label or a null or NaN feature belong to no fit and get no prediction.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veritab.functions.scalar import uniform_hash

#: Parts in which the sums of one fit are added first; scans after which a fit is taken as it is; largest
#: relative change of the objective and largest step at which a fit has ended.
PARTS, MAX_SCANS, TOLERANCE, STEP = 32, 40, 1e-13, 1e-9


class Fit(NamedTuple):
    """One fit: penalty, share of L1, left-out fold (None: none), share of the remaining rows in order
    of their hash, positions of features left out, balanced class weights."""
    lam: float
    alpha: float = 0.0
    fold: int | None = None
    fraction: float = 1.0
    without: tuple[int, ...] = ()
    balanced: bool = True


def rows_of(df: DataFrame, array_col: str, key: str, label: str = "label", fold_col: str = "fold", seed=42) -> DataFrame:
    """x, y, fold, u of every usable row; u is the row's uniform hash, which fractions are cut by."""
    x = F.col(array_col).cast("array<double>")
    fold = F.col(fold_col).cast("int") if fold_col in df.columns else F.lit(-1)
    return (df.select(x.alias("x"), F.col(label).cast("double").alias("y"), F.coalesce(fold, F.lit(-1)).alias("fold"),
                      uniform_hash(key, seed=seed).alias("u"))
            .where(F.col("y").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v))))


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features with a leading 1, label, fold, u)."""
    n = len(batch)
    flat = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(n, -1)
    return (np.hstack([np.ones((n, 1)), flat]), *(batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "u")))


def _own(fit: Fit, fold: np.ndarray, u: np.ndarray) -> np.ndarray:
    """Rows that the fit learns from."""
    own = u < fit.fraction if fit.fraction < 1 else np.ones(len(u), dtype=bool)
    return own if fit.fold is None else own & (fold != fit.fold)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1 / (1 + e), e / (1 + e))


def _summed(rows: DataFrame, per_fit, width: int) -> dict[int, np.ndarray]:  # noqa: ANN001
    """Sum over all rows of ``per_fit(batch)`` (fit number -> vector of ``width`` numbers), per fit."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            if len(batch):
                for i, v in per_fit(batch):
                    total[i] = total[i] + v if i in total else v
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         ["fit", "sums"])

    def add(key: tuple, part: pa.Table) -> pa.Table:
        total = np.zeros(width)
        for v in part.column("sums").to_pylist():
            total += np.frombuffer(v)
        return pa.table({"fit": pa.array([key[0].as_py()], pa.int32()), "sums": pa.array([total.tobytes()], pa.binary())})

    sums = rows.mapInArrow(run, "fit int, sums binary")
    parts = sums.groupBy("fit", (F.spark_partition_id() % PARTS).alias("part")).applyInArrow(add, "fit int, sums binary")
    return {r["fit"]: np.frombuffer(r["sums"]) for r in parts.groupBy("fit").applyInArrow(add, "fit int, sums binary").collect()}


def _class_weights(rows: DataFrame, fits: Sequence[Fit]) -> np.ndarray:
    """(weight of class 0, weight of class 1, total weight) of every fit, from its own rows."""

    def counts(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        y, fold, u = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "fold", "u"))
        for i, fit in enumerate(fits):
            own = _own(fit, fold, u)
            yield i, np.array([np.sum(own & (y == 0)), np.sum(own & (y == 1))], dtype=np.float64)

    found = _summed(rows.select("y", "fold", "u"), counts, 2)
    out = np.zeros((len(fits), 3))
    for i, fit in enumerate(fits):
        n = found.get(i, np.zeros(2))
        present = np.count_nonzero(n)
        w = np.divide(n.sum(), present * n, out=np.zeros(2), where=n > 0) if fit.balanced else np.ones(2)
        out[i] = (*w, (w * n).sum())
    return out


def _step(b: np.ndarray, g: np.ndarray, h: np.ndarray, fit: Fit, free: np.ndarray) -> np.ndarray:
    """Minimum of the quadratic model at ``b`` with the penalty, over the free coefficients."""
    l2 = np.r_[0.0, np.full(len(b) - 1, fit.lam * (1 - fit.alpha))]
    l1 = np.r_[0.0, np.full(len(b) - 1, fit.lam * fit.alpha)]
    a = h + np.diag(l2)
    new = b.copy()
    if not fit.alpha:
        grad = (g + l2 * b)[free]
        new[free] = b[free] - np.linalg.lstsq(a[np.ix_(free, free)], grad, rcond=None)[0]
        return new
    # g + a (x - b) + l2 b: gradient of the smooth part at x
    slope = g + l2 * b
    for _ in range(10_000):
        moved = 0.0
        for j in np.flatnonzero(free):
            if a[j, j] <= 0:
                continue
            t = new[j] - slope[j] / a[j, j]
            x = np.sign(t) * max(abs(t) - l1[j] / a[j, j], 0.0)
            if x != new[j]:
                slope += a[:, j] * (x - new[j])
                moved = max(moved, abs(x - new[j]))
                new[j] = x
        if moved < 1e-12 * max(1.0, np.abs(new).max()):
            break
    return new


def _penalty(b: np.ndarray, fit: Fit) -> float:
    return fit.lam * ((1 - fit.alpha) / 2 * float(b[1:] @ b[1:]) + fit.alpha * float(np.abs(b[1:]).sum()))


def fit_many(rows: DataFrame, fits: Sequence[Fit], max_scans: int = MAX_SCANS) -> tuple[np.ndarray, int]:
    """(coefficients of every fit, the intercept first; scans used). ``rows`` as :func:`rows_of` gives them.

    A fit without rows, or whose rows have one class, keeps the coefficients 0 and an intercept that tells
    the class (-1 or 1; 0 without rows)."""
    first = rows.select("x").first()
    p = len(first["x"]) + 1 if first else 1
    weights = _class_weights(rows, fits)
    beta = np.zeros((len(fits), p))
    free = np.ones((len(fits), p), dtype=bool)
    for i, fit in enumerate(fits):
        free[i, [j + 1 for j in fit.without]] = False
        for c in (0, 1):  # both classes are needed for a finite intercept
            if weights[i, 2] and not _has_class(weights[i], fit, c):
                beta[i, 0] = 1.0 if c == 0 else -1.0
    active = [i for i in range(len(fits)) if weights[i, 2] > 0 and beta[i, 0] == 0 or not fits[i].balanced and weights[i, 2] > 0]
    low = np.tril_indices(p)
    held = {i: (np.inf, beta[i].copy(), beta[i].copy()) for i in active}  # objective, point, proposed point
    scans = 0
    while active and scans < max_scans:
        scans += 1
        trial = {i: held[i][2] for i in active}

        def sums(batch: pa.RecordBatch, trial=trial) -> Iterator[tuple[int, np.ndarray]]:  # noqa: ANN001
            x, y, fold, u = _matrix(batch)
            for i, b in trial.items():
                own = _own(fits[i], fold, u)
                xo, yo = x[own], y[own]
                if not len(yo):
                    continue
                w = np.where(yo == 1, weights[i, 1], weights[i, 0]) / weights[i, 2]
                z = xo @ b
                q = _sigmoid(z)
                loss = float(w @ (np.logaddexp(0.0, z) - yo * z))
                h = (xo * (w * q * (1 - q))[:, None]).T @ xo
                yield i, np.r_[loss, xo.T @ (w * (q - yo)), h[low]]

        found = _summed(rows, sums, 1 + p + len(low[0]))
        going = []
        for i in active:
            before, point, proposed = held[i]
            v = found[i]
            objective = v[0] + _penalty(proposed, fits[i])
            if objective > before + 1e-15 * abs(before):  # too far: half the step
                if np.abs(proposed - point).max() <= STEP * max(1.0, np.abs(point).max()):
                    beta[i] = point
                    continue
                held[i] = (before, point, (point + proposed) / 2)
                going.append(i)
                continue
            h = np.zeros((p, p))
            h[low] = v[1 + p:]
            h = h + np.tril(h, -1).T
            new = _step(proposed, v[1:1 + p], h, fits[i], free[i])
            beta[i] = proposed
            small = np.abs(new - proposed).max() <= STEP * max(1.0, np.abs(proposed).max())
            if small or before - objective <= TOLERANCE * abs(objective) and np.isfinite(before):
                beta[i] = new if small else proposed
                continue
            held[i] = (objective, proposed, new)
            going.append(i)
        active = going
    return beta, scans + 1


def _has_class(weights: np.ndarray, fit: Fit, c: int) -> bool:
    """Balanced weights are 0 for a class without rows; unbalanced fits are regularised by their rows."""
    return weights[c] > 0 if fit.balanced else True


def confusions(rows: DataFrame, fits: Sequence[Fit], beta: np.ndarray) -> dict[tuple[int, str], dict]:
    """Accuracy, precision, recall and F1 of every fit on the rows it learnt from (``train``) and on its
    left-out fold (``validation``), from one scan."""

    def cells(batch: pa.RecordBatch) -> Iterator[tuple[int, np.ndarray]]:
        x, y, fold, u = _matrix(batch)
        hit = x @ beta.T >= 0
        for i, fit in enumerate(fits):
            out = []
            for part in (_own(fit, fold, u), fold == fit.fold if fit.fold is not None else np.zeros(len(y), bool)):
                yes, true = hit[part, i], y[part] == 1
                out += [np.sum(yes & true), np.sum(yes & ~true), np.sum(~yes & true), np.sum(~yes & ~true)]
            yield i, np.array(out, dtype=np.float64)

    found = _summed(rows, cells, 8)
    return {(i, part): metrics_of(found.get(i, np.zeros(8))[at:at + 4]) for i in range(len(fits)) for part, at in (("train", 0), ("validation", 4))}


def metrics_of(cells: np.ndarray) -> dict:
    """Metrics of (tp, fp, fn, tn), 0 where undefined; ``cells`` holds these."""
    tp, fp, fn, tn = (float(x) for x in cells)
    n = tp + fp + fn + tn
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    return {"cells": np.asarray(cells), "accuracy": (tp + tn) / n if n else 0.0, "precision": precision, "recall": recall,
            "f1": 2 * precision * recall / (precision + recall) if precision + recall else 0.0}


def linear_probability(array_col: str, b: Sequence[float]) -> Column:
    """Probability of class 1 of one fit as a column expression."""
    terms = F.zip_with(F.col(array_col).cast("array<double>"), F.array(*[F.lit(float(v)) for v in b[1:]]), lambda x, c: x * c)
    z = F.aggregate(terms, F.lit(float(b[0])), lambda a, t: a + t)
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def out_of_fold(df: DataFrame, array_col: str, by_fold: dict[int, Sequence[float]], fold_col: str = "fold") -> DataFrame:
    """fold, label, prediction, prediction_probability of every row by the fit that left out its fold."""
    probability = F.lit(None).cast("double")
    for fold, b in by_fold.items():
        probability = F.when(F.col(fold_col) == fold, linear_probability(array_col, b)).otherwise(probability)
    scored = df.select(fold_col, "label", probability.alias("prediction_probability")).where("prediction_probability is not null")
    return scored.withColumn("prediction", (F.col("prediction_probability") >= 0.5).cast("int"))
