"""Second-order boosted trees (M4) on quantile-binned features.

A table of one row per training row is written once: label, hash, margin and one byte per feature (its
quantile bin; 255 for a missing value). Each level of a tree is one scan of it: tasks route their rows to the
open nodes, sum gradient and Hessian of the logistic loss per (node, feature, bin), and emit these sums
only; they are added per (node, feature), running sums over at most 256 bins give the gain of every cut, and
the best cut of each (node, feature) comes to the driver. No task holds the rows of a node, and the sums do not grow
with the rows.

Gradients are whole multiples of a power of two that the number of rows fixes, so sums are exact in any
order: the trees do not depend on partitions, retries or lost executors.

Gain of a cut: ``GL^2/(HL+l2) + GR^2/(HR+l2) - G^2/(H+l2)``, each side with a Hessian of at least
``min_child``; rows that miss the feature go to the side with the larger gain (right on ties). Ties between
cuts fall to the smallest feature, then the smallest bin. Leaf: ``-rate * G/(H+l2)``.

Rows with a null label or null array are not learnt from; null or NaN elements are missing values. Rows of equal
``key`` are drawn together. An empty table gives a model without trees.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.pandas.types import from_arrow_schema

from veritab.functions.scalar import col_of
from veritab.session import run_table

#: Bin of a missing value; sums one task may hold; rows that one task of a small table takes; trees after
#: which margins are written again; rows summed at once, whose sums are exact as doubles; cuts judged at once.
MISSING, CELLS, TASK_ROWS, REFRESH, PIECE, CUTS = 255, 4_000_000, 200_000, 10, 65_536, 1_000
_CUT = pa.schema([("node", pa.int32()), ("feature", pa.int32()), ("bin", pa.int32()), ("missing_left", pa.bool_()), ("g", pa.float64()),
                  ("h", pa.float64()), ("gl", pa.float64()), ("hl", pa.float64()), ("gain", pa.float64())])


class Tree(NamedTuple):
    """Nodes in heap order (children of i: 2i+1, 2i+2). ``feature`` -1: leaf with ``value``. A row goes
    left when its bin is at most ``bin`` (its value at most ``cut``)."""
    feature: np.ndarray
    bin: np.ndarray
    cut: np.ndarray
    missing_left: np.ndarray
    value: np.ndarray
    gain: np.ndarray


def empty_tree(depth: int) -> Tree:
    n = 2 ** (depth + 1) - 1
    return Tree(np.full(n, -1), np.zeros(n, dtype=np.int64), np.zeros(n), np.zeros(n, dtype=bool), np.zeros(n), np.zeros(n))


def _routes(tree: Tree) -> tuple[np.ndarray, ...]:
    """(feature, shift, limit) of each inner node and the node that each place of the last level stands for: a row goes
    right when its bin plus ``shift``, modulo 256, is over ``limit``, so a missing value (255) that goes left becomes 0. Below a leaf
    rows go left to the end."""
    inner = len(tree.feature) // 2
    end, stopped = np.arange(len(tree.feature)), tree.feature < 0
    for i in range(1, len(end)):
        if stopped[(i - 1) // 2]:
            end[i], stopped[i] = end[(i - 1) // 2], True
    stay = stopped[:inner]
    shift = np.where(stay, 0, tree.missing_left[:inner]).astype(np.uint8)
    limit = np.where(stay, MISSING, tree.bin[:inner] + shift).astype(np.uint8)
    return np.where(stay, 0, tree.feature[:inner]), shift, limit, end


def _binned_leaves(tree: Tree, x: np.ndarray) -> np.ndarray:
    feature, shift, limit, end = _routes(tree)
    cells, base, at = np.ascontiguousarray(x).ravel(), np.arange(len(x)) * x.shape[1], np.zeros(len(x), dtype=np.int64)
    for _ in range(len(end).bit_length() - 1):
        at += at + 1 + (cells[base + feature[at]] + shift[at] > limit[at])
    return end[at]


def leaves(tree: Tree, x: np.ndarray, binned: bool) -> np.ndarray:
    """Heap number of the node each row ends in."""
    if binned:
        return _binned_leaves(tree, x)
    at = np.zeros(len(x), dtype=np.int64)
    rows = np.arange(len(x))
    while True:
        f = tree.feature[at]
        inner = f >= 0
        if not inner.any():
            return at
        v = x[rows, np.where(inner, f, 0)]
        left = np.where(np.isnan(v), tree.missing_left[at], v <= tree.cut[at])
        at = np.where(inner, 2 * at + np.where(left, 1, 2), at)


def _margin(trees: Sequence[Tree], x: np.ndarray, binned: bool) -> np.ndarray:
    out = np.zeros(len(x))
    for t in trees:
        out += t.value[leaves(t, x, binned)]
    return out


def _sigmoid(z: np.ndarray) -> np.ndarray:
    e = np.exp(-np.abs(z))
    return np.where(z >= 0, 1 / (1 + e), e / (1 + e))


def _uniform(h: np.ndarray, tree: int) -> np.ndarray:
    """Uniform number in [0, 1) of a row's 64-bit hash and the tree's number (mixing steps of splitmix64)."""
    z = h.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % 2 ** 64)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / 2.0 ** 53


def quantile_edges(rows: DataFrame, array_col: str, bins: int) -> dict[int, np.ndarray]:
    """Upper edges of at most ``bins`` quantile bins of each feature, from mergeable sketches."""
    cells = rows.select(F.posexplode(F.col(array_col)).alias("feature", "v")).where("v IS NOT NULL AND NOT isnan(v)")
    shares = [i / bins for i in range(1, bins)]
    found = cells.groupBy("feature").agg(F.percentile_approx("v", shares, 10_000).alias("edges"))
    return {r["feature"]: np.unique(np.array(r["edges"], dtype=np.float64)) for r in found.collect()}  # features x bins numbers


class BoostedTrees(NamedTuple):
    """M4: 100 rounds, depth 6, step 0.1, rows and features drawn at 0.8 per tree, positive class weight 1.7."""
    array_col: str
    key: tuple[str, ...]
    label: str = "label"
    rounds: int = 100
    max_depth: int = 6
    rate: float = 0.1
    subsample: float = 0.8
    col_sample: float = 0.8
    pos_weight: float = 1.7
    l2: float = 1.0
    min_child: float = 1.0
    bins: int = 255
    seed: int = 42

    def fit(self, df: DataFrame) -> "BoostedModel":
        rows = df.select(F.col(self.array_col).cast("array<double>").alias("x"), col_of(self.label).cast("double").alias("y"),
                         F.xxhash64(F.lit(self.seed), *[col_of(k) for k in self.key]).alias("h")).where("x IS NOT NULL AND y IS NOT NULL")
        n, width = rows.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
        if not n or not width:
            return BoostedModel([], self.array_col, 0)
        if not 2 <= self.bins <= MISSING:
            raise ValueError(f"bins must be 2 to {MISSING}")
        found = quantile_edges(rows, "x", self.bins)
        edges = [found.get(f, np.zeros(0)) for f in range(width)]
        # small tables: few full tasks instead of many empty ones; larger ones keep their partitions
        parts = -(-n // TASK_ROWS)
        table = run_table(self._binned(rows, edges).coalesce(parts))
        tasks = min(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
        scale = 2.0 ** min(30, 61 - int(np.ceil(np.log2(n * max(self.pos_weight, 1.0) + 1))))
        rng = np.random.default_rng(self.seed)
        trees: list[Tree] = []
        fresh = 0  # trees whose values the written margins hold
        for t in range(self.rounds):
            used = np.sort(rng.choice(width, max(1, int(self.col_sample * width)), replace=False))
            trees.append(self._grow(table, trees[fresh:], t, used, edges, scale, tasks))
            if len(trees) - fresh == REFRESH and t + 1 < self.rounds:
                table, fresh = run_table(_advanced(table, trees[fresh:])), len(trees)
        return BoostedModel(trees, self.array_col, width)

    def _binned(self, rows: DataFrame, edges: list[np.ndarray]) -> DataFrame:
        width = len(edges)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                x = _dense(batch.column("x").to_pylist(), width)
                b = np.full(x.shape, MISSING, dtype=np.uint8)
                for f in range(width):
                    known = ~np.isnan(x[:, f])
                    b[known, f] = np.searchsorted(edges[f], x[known, f], side="left")
                yield pa.RecordBatch.from_arrays(
                    [batch.column("y"), batch.column("h"), pa.array(np.zeros(len(batch))), pa.array([r.tobytes() for r in b], pa.binary())],
                    ["y", "h", "margin", "bins"])

        return rows.mapInArrow(run, "y double, h long, margin double, bins binary")

    def _grow(self, table: DataFrame, recent: list[Tree], number: int, used: np.ndarray, edges: list[np.ndarray], scale: float, tasks: int) -> Tree:
        tree, open_ = empty_tree(self.max_depth), [0]
        for _ in range(self.max_depth):
            if not open_:
                break
            step = max(1, CELLS // (len(used) * 256))  # more scans for very wide tables, never larger sums
            best: dict[int, dict] = {}
            for at in range(0, len(open_), step):
                nodes = open_[at:at + step]
                sums = _sums(table, recent, tree, nodes, number, used, self.subsample, self.pos_weight, scale)
                best |= _cuts(sums, min(tasks, len(nodes) * len(used)), scale, self.l2, self.min_child)
            open_ = []
            for i, r in best.items():
                tree.value[i] = -self.rate * r["g"] / (r["h"] + self.l2)
                if r["gain"] is None or r["gain"] <= 0:
                    continue
                f, b = r["feature"], r["bin"]
                tree.feature[i], tree.bin[i], tree.missing_left[i], tree.gain[i] = f, b, r["missing_left"], r["gain"]
                tree.cut[i] = edges[f][b] if b < len(edges[f]) else np.inf
                for child, g, h in ((2 * i + 1, r["gl"], r["hl"]), (2 * i + 2, r["g"] - r["gl"], r["h"] - r["hl"])):
                    tree.value[child] = -self.rate * g / (h + self.l2)
                    if h >= 2 * self.min_child:  # smaller ones have no cut
                        open_.append(child)
        return tree


def _cuts(sums: DataFrame, tasks: int, scale: float, l2: float, min_child: float) -> dict[int, dict]:
    """The best cut of each node (gain null where no cut is allowed). Sums of a (node, feature) meet in one task;
    the driver receives one row of each, at most CELLS / 256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            sums = _in_place(batch.column("sums"), np.int64).reshape(len(batch), 2, 256)
            for *key, v in zip(batch.column("node").to_pylist(), batch.column("feature").to_pylist(), sums):
                key = tuple(key)
                if key in total:
                    total[key] += v
                else:
                    total[key] = v.copy()
        keys = list(total)
        for at in range(0, len(keys), CUTS):
            v = np.stack([total[key] for key in keys[at:at + CUTS]])
            upto = np.cumsum(v[:, :, :MISSING], axis=2)
            # cuts x bins x (missing right, missing left); whole numbers until here, so the same in any order
            gl, hl = (np.stack([upto[:, k], upto[:, k] + v[:, k, MISSING:]], axis=2) / scale for k in (0, 1))
            g, h = (x[:, None, None] for x in v.sum(axis=2).T / scale)
            gr, hr = g - gl, h - hl
            ok = (np.minimum(hl, hr) >= min_child) & (hl > 0) & (hr > 0)
            gain = np.where(ok, gl * gl / (np.where(ok, hl, 0) + l2) + gr * gr / (np.where(ok, hr, 0) + l2) - g * g / (h + l2), -np.inf)
            best = gain.reshape(len(v), -1).argmax(axis=1)  # the first of equal gains: smallest bin, missing rows right
            i, j = np.divmod(best, 2)
            own = np.arange(len(v))
            node, feature = zip(*keys[at:at + CUTS])
            yield pa.RecordBatch.from_arrays(
                [pa.array(node, pa.int32()), pa.array(feature, pa.int32()), pa.array(i, pa.int32()), pa.array(j == 1), pa.array(g.ravel()), pa.array(h.ravel()),
                 pa.array(gl[own, i, j]), pa.array(hl[own, i, j]), pa.array(gain[own, i, j], mask=~ok[own, i, j])], schema=_CUT)

    best: dict[int, dict] = {}
    for r in sums.repartition(tasks, "node", "feature").mapInArrow(run, from_arrow_schema(_CUT)).collect():
        order = (-np.inf if r["gain"] is None else r["gain"], -r["feature"])
        if r["node"] not in best or order > best[r["node"]][0]:
            best[r["node"]] = (order, r)
    return {node: r for node, (_, r) in sorted(best.items())}


def _dense(lists: list, width: int) -> np.ndarray:
    """Rows of doubles; null, NaN and absent elements are NaN."""
    out = np.full((len(lists), width), np.nan)
    for i, v in enumerate(lists):
        if v is not None:
            part = np.array(v[:width], dtype=np.float64)
            out[i, :len(part)] = part
    return out


def _in_place(column: pa.Array, kind: type) -> np.ndarray:
    """The numbers of binaries without nulls, as they lie in the column."""
    wide = pa.types.is_large_binary(column.type)
    ends = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return np.frombuffer(column.buffers()[2], np.uint8)[ends[0]:ends[-1]].view(kind)


def _bins_of(batch: pa.RecordBatch) -> np.ndarray:
    return _in_place(batch.column("bins"), np.uint8).reshape(len(batch), -1)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows of the batches in batches of PIECE rows, the last one of fewer."""
    held: list[pa.RecordBatch] = []
    room = PIECE
    for whole in batches:
        at = 0
        while at < len(whole):
            held.append(whole.slice(at, room))
            at, room = at + len(held[-1]), room - len(held[-1])
            if not room:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, room = [], PIECE
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _advanced(table: DataFrame, trees: list[Tree]) -> DataFrame:
    """The table with the values of ``trees`` added to its margins."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if len(batch):
                m = batch.column("margin").to_numpy() + _margin(trees, _bins_of(batch), True)
                yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(m))

    return table.mapInArrow(run, table.schema)


def _sums(table: DataFrame, recent: list[Tree], tree: Tree, nodes: Sequence[int], number: int, used: np.ndarray,
          subsample: float, pos_weight: float, scale: float) -> DataFrame:
    """node, feature, sums (gradient and Hessian of 256 bins) of this tree's drawn rows in ``nodes``, as whole multiples of 1/scale."""
    slot = np.full(len(tree.feature), -1)
    slot[list(nodes)] = np.arange(len(nodes))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shape = (len(used), len(nodes) * 256)
        total = np.zeros((2, *shape), dtype=np.int64)
        for batch in _pieces(batches):
            own = np.flatnonzero(_uniform(batch.column("h").to_numpy().astype(np.int64), number) < subsample)
            b = _bins_of(batch)[own]
            place = slot[leaves(tree, b, True)]
            inside = place >= 0
            if not inside.any():
                continue
            if not inside.all():
                own, b, place = own[inside], b[inside], place[inside]
            y = batch.column("y").to_numpy()[own]
            p = _sigmoid(batch.column("margin").to_numpy()[own] + _margin(recent, b, True))
            w = np.where(y > 0, pos_weight, 1.0)
            g = np.rint(w * (p - (y > 0)) * scale)
            h = np.rint(w * p * (1 - p) * scale)
            columns, first = np.ascontiguousarray(b[:, used].T), place * 256
            for i in range(len(used)):
                code = first + columns[i]
                for k, v in enumerate((g, h)):
                    total[k, i] += np.bincount(code, weights=v, minlength=shape[1]).astype(np.int64)
        i, place = np.nonzero(total.reshape(2, len(used), len(nodes), 256).any(axis=(0, 3)))
        packed = [total[:, f, p * 256:(p + 1) * 256].tobytes() for f, p in zip(i, place)]
        yield pa.RecordBatch.from_arrays([pa.array(np.asarray(nodes)[place], pa.int32()), pa.array(used[i], pa.int32()), pa.array(packed, pa.binary())],
                                         ["node", "feature", "sums"])

    return table.mapInArrow(run, "node int, feature int, sums binary")


class BoostedModel(NamedTuple):
    """Fitted trees; the size is bounded by rounds and depth."""
    trees: list[Tree]
    array_col: str
    width: int

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds ``probability`` (vector of both classes) and ``prediction``; null arrays count as all missing."""
        trees, width = self.trees, self.width

        @pandas_udf("double")
        def positive(x: pd.Series) -> pd.Series:
            return pd.Series(_sigmoid(_margin(trees, _dense(list(x), width), False)))

        p = positive(F.col(self.array_col).cast("array<double>"))
        return (df.withColumn("_positive", p).withColumn("probability", array_to_vector(F.array(1 - F.col("_positive"), F.col("_positive"))))
                .withColumn("prediction", (F.col("_positive") >= 0.5).cast("double")).drop("_positive"))

    def gains(self) -> dict[int, float]:
        """Total gain per feature that was cut."""
        out: dict[int, float] = {}
        for t in self.trees:
            for f, g in zip(t.feature, t.gain):
                if f >= 0:
                    out[int(f)] = out.get(int(f), 0.0) + float(g)
        return out
