"""Correlation of many columns in one scan.

Columns are cut into blocks. Each task keeps, for every pair of blocks, six matrices over the rows at which both columns
are present: count, mean of either column, sums of squares about them, and co-moment. Batches and tasks merge by the
update formula of Chan, Golub and LeVeque, so no value is subtracted from a large sum. A task emits one row per pair of
blocks; rows of a pair are merged in parts first, then one task per pair unfolds its correlations. No row and no
expression grows with the number of pairs.

Null and NaN are missing. A pair with fewer than two common rows, or a column that does not vary at them, has a null
correlation; a column that varies has 1 with itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veritab.functions.scalar import col_of

#: Columns per block; pairs of blocks one scan holds per task (48 * BLOCK^2 bytes each); parts of a pair merged first.
BLOCK, PAIRS, PARTS = 64, 1_500, 32


def _moments(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """(6, columns of x, columns of y): count, mean x, mean y, squares x, squares y, co-moment over common rows."""
    vx, vy = (~np.isnan(v) for v in (x, y))
    px, py = (np.divide(np.nansum(v, axis=0), m.sum(0), out=np.zeros(v.shape[1]), where=m.any(axis=0)) for v, m in ((x, vx), (y, vy)))
    x0, y0, vx, vy = np.where(vx, x - px, 0.0), np.where(vy, y - py, 0.0), vx.astype(float), vy.astype(float)
    n = vx.T @ vy
    one = np.maximum(n, 1)
    sx, sy, qx, qy = x0.T @ vy, vx.T @ y0, (x0 * x0).T @ vy, vx.T @ (y0 * y0)
    mx, my = qx - sx * sx / one, qy - sy * sy / one
    # what is left of equal values is rounding
    mx, my = np.where(mx <= 1e-13 * qx, 0.0, mx), np.where(my <= 1e-13 * qy, 0.0, my)
    return np.stack([n, np.where(n > 0, px[:, None] + sx / one, 0), np.where(n > 0, py[None] + sy / one, 0), mx, my, x0.T @ y0 - sx * sy / one])


def _merge(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Moments of both parts together."""
    n = a[0] + b[0]
    share = np.divide(b[0], n, out=np.zeros_like(n), where=n > 0)
    dx, dy = b[1] - a[1], b[2] - a[2]
    w = a[0] * share
    return np.stack([n, np.where(a[0] > 0, a[1] + dx * share, b[1]), np.where(a[0] > 0, a[2] + dy * share, b[2]),
                     a[3] + b[3] + dx * dx * w, a[4] + b[4] + dy * dy * w, a[5] + b[5] + dx * dy * w])


def _pairs(width: int) -> list[tuple[int, int]]:
    blocks = -(-width // BLOCK)
    return [(i, j) for i in range(blocks) for j in range(i, blocks)]


def correlations(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """feature_a, feature_b, corr of every ordered pair of ``cols``."""
    cols = list(cols)
    width, block = len(cols), BLOCK
    values = df.select(*[col_of(c).cast("double").alias(f"_{i}") for i, c in enumerate(cols)])
    out = None
    every = _pairs(width)
    for start in range(0, len(every), PAIRS):  # one scan up to about 3,400 columns
        pairs = every[start:start + PAIRS]
        used = sorted({b for p in pairs for b in p})
        part = _scan(values.select(*[f"_{c}" for b in used for c in range(b * block, min(width, (b + 1) * block))]), pairs, used, width)
        out = part if out is None else out.unionByName(part)
    if out is None:
        return df.sparkSession.createDataFrame([], "feature_a string, feature_b string, corr double")
    return _unfolded(out, cols)


def _scan(values: DataFrame, pairs: list[tuple[int, int]], used: list[int], width: int) -> DataFrame:
    """i, j, moments of every pair of blocks, one row per pair."""
    block = BLOCK
    size = {b: min(width, (b + 1) * block) - b * block for b in used}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            if not len(batch):
                continue
            m = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1)
            at, parts = 0, {}
            for b in used:
                parts[b] = m[:, at:at + size[b]]
                at += size[b]
            for i, j in pairs:
                new = _moments(parts[i], parts[j])
                total[i, j] = _merge(total[i, j], new) if (i, j) in total else new
        yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in total], pa.int32()), pa.array([p[1] for p in total], pa.int32()),
                                          pa.array([v.tobytes() for v in total.values()], pa.binary())], ["i", "j", "moments"])

    def add(key: tuple, part: pa.Table) -> pa.Table:
        i, j = (k.as_py() for k in key[:2])
        total = None
        for v in part.column("moments"):
            v = np.frombuffer(v.as_py()).reshape(6, size[i], size[j])
            total = v if total is None else _merge(total, v)
        return pa.table({"i": pa.array([i], pa.int32()), "j": pa.array([j], pa.int32()), "moments": pa.array([total.tobytes()], pa.binary())})

    schema = "i int, j int, moments binary"
    return (values.mapInArrow(run, schema).groupBy("i", "j", (F.spark_partition_id() % PARTS).alias("part")).applyInArrow(add, schema)
            .groupBy("i", "j").applyInArrow(add, schema))


def _unfolded(moments: DataFrame, cols: list[str]) -> DataFrame:
    width, block = len(cols), BLOCK

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, v in zip(*(batch.column(c).to_pylist() for c in ("i", "j", "moments"))):
                a, b = (np.arange(k * block, min(width, (k + 1) * block)) for k in (i, j))
                n, mean_x, mean_y, sx, sy, xy = np.frombuffer(v).reshape(6, len(a), len(b))
                # a spread below the resolution of a double about its mean is none
                varies = (n > 1) & (sx > 1e-28 * n * mean_x ** 2) & (sy > 1e-28 * n * mean_y ** 2) & (sx > 0) & (sy > 0)
                r = np.divide(xy, np.sqrt(sx) * np.sqrt(sy), out=np.full(n.shape, np.nan), where=varies)
                r = np.where(varies & (a[:, None] == b[None]), 1.0, np.clip(r, -1, 1))
                for first, second, values in ((a, b, r), *([(b, a, r.T)] if i != j else [])):
                    left, right = np.repeat(first, len(second)), np.tile(second, len(first))
                    flat = values.ravel()
                    yield pa.RecordBatch.from_arrays([pa.array([cols[k] for k in left]), pa.array([cols[k] for k in right]), pa.array(flat, mask=np.isnan(flat))],
                                                     ["feature_a", "feature_b", "corr"])

    return moments.mapInArrow(run, "feature_a string, feature_b string, corr double")
