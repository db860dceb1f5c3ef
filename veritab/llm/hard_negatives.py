"""Operator 12: hard negatives by Strassen multiplication of anchor-candidate tiles and mergeable
heaps.

Components are quantised to floor(256 * x); a score is the exact integer inner product. Anchors are
read in blocks of bounded size. For every block the rows are scanned twice, without a shuffle of
vectors:

1. Positives. A task multiplies the block's anchors of a label with its rows of that label, tile by
   tile, and keeps a heap of the best rows per anchor; heaps of all tasks are merged per anchor.
2. Windows. A task multiplies the anchors with its rows, and for every (anchor, positive) keeps a heap
   of the best rows of other labels whose score lies in the positive's window; heaps are merged.

Tiles are int64 matrices padded with zeros to even halves and multiplied by Strassen's recursion down
to ``LEAF``. Sums and products of int64 are exact modulo 2^64, so a score is exact as long as
it fits in 64 bits; a tile whose bounds do not promise that (with the window's factors) is multiplied
in Python integers instead.

Defined results: rows with a null id, label or vector, or a null or non-finite component take no part.
A vector shorter than another counts as padded with zeros (an empty one scores 0). Rows that repeat an
id with equal label and score count once; a row with the anchor's own id is never its positive or
negative. An anchor id that repeats is one anchor, its smallest (label, vector). Scores beyond the range of
long are ranked exactly and returned as its nearest end. An anchor without positives, or a positive
without rows in its window, gives no rows; an empty table gives none. Only vec_id, label and
embedding are read, so other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, table

#: Bytes of anchor vectors in one broadcast block; scores of a tile; side at which recursion ends.
BLOCK_BYTES, TILE, LEAF = 8 << 20, 4 << 20, 64
#: Positives per anchor, negatives per positive, window of the negative score in percent.
POSITIVES, NEGATIVES, LOW, HIGH = 5, 10, 30, 90
SCALE = 256


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """Exact product of integer matrices by seven half-size products per level.

    Sides are padded with zeros to even numbers at each level; a side of at most ``leaf`` ends the
    recursion."""
    m, k, n = a.shape[0], a.shape[1], b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a = np.pad(a, ((0, m % 2), (0, k % 2)))
    b = np.pad(b, ((0, k % 2), (0, n % 2)))
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), dtype=a.dtype)
    out[:h, :j], out[:h, j:] = p1 + p4 - p5 + p7, p3 + p5
    out[h:, :j], out[h:, j:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


def exact_scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products of all anchors (rows of a matrix) and rows, whose widths may differ."""
    wide = min(anchors.shape[1], rows.shape[1])
    a, b = anchors[:, :wide], rows[:, :wide]
    if a.dtype != object and b.dtype != object:
        most = [max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0)))) for x in (a, b)]
        if most[0] * most[1] * max(wide, 1) * 100 >= 1 << 63:
            a, b = a.astype(object), b.astype(object)
    elif a.dtype != b.dtype:
        a, b = a.astype(object), b.astype(object)
    if not wide:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    return strassen(a, np.ascontiguousarray(b.T))


def quantised(vectors: list) -> np.ndarray:
    """Matrix of floor(256 * x), short vectors padded with zeros; Python integers where a component
    does not fit in int64."""
    sizes = np.array([len(v) for v in vectors], dtype=np.int64)
    flat = np.floor(np.concatenate([np.asarray(v, dtype=np.float64) for v in vectors]) * SCALE) if len(vectors) else np.zeros(0)
    wide = int(sizes.max(initial=0))
    big = len(flat) and np.abs(flat).max() >= 2.0 ** 62
    out = np.zeros((len(vectors), wide), dtype=object if big else np.int64)
    inside = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    values = np.array([int(x) for x in flat.tolist()] + [None], dtype=object)[:-1] if big else flat.astype(np.int64)
    out[np.repeat(np.arange(len(vectors)), sizes), inside] = values
    return out


def best(scores: np.ndarray, ids: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The heap of ``size`` best (score, id): higher scores first, then smaller ids; equal pairs
    count once."""
    order = np.argsort(ids, kind="stable")
    order = order[np.argsort(-scores[order], kind="stable")]
    if len(order) > 1:
        s, i = scores[order], ids[order]
        order = order[np.r_[True, (s[1:] != s[:-1]) | (i[1:] != i[:-1])]]
    return scores[order[:size]], ids[order[:size]]


def _pruned(scores: np.ndarray, size: int) -> np.ndarray:
    """Places of all scores that are among the ``size`` largest, ties included."""
    if len(scores) <= size:
        return np.arange(len(scores))
    if scores.dtype == object:
        return np.flatnonzero(scores >= sorted(scores, reverse=True)[size - 1])
    return np.flatnonzero(scores >= np.partition(scores, len(scores) - size)[len(scores) - size])


def _push(heaps: dict, key: object, scores: np.ndarray, ids: np.ndarray, size: int) -> None:
    """Merges new pairs into the heap of ``key``; a row that repeats may take several places at first."""
    if not len(scores):
        return
    if key in heaps:
        scores, ids = np.concatenate([heaps[key][0], scores]), np.concatenate([heaps[key][1], ids])
    heaps[key] = best(scores, ids, size)


def _tiles(batch: pa.RecordBatch, anchors: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, quantised vectors) of as many rows as make TILE scores with the anchors."""
    size = max(TILE // max(anchors, 1), LEAF)
    for at in range(0, len(batch), size):
        part = batch.slice(at, size)
        vectors = part.column("vector")
        flat = vectors.flatten().to_numpy(zero_copy_only=False)
        cuts = np.cumsum(pc.list_value_length(vectors).to_numpy(zero_copy_only=False).astype(np.int64))
        yield part.column("id").to_numpy(zero_copy_only=False), part.column("tag").to_numpy(zero_copy_only=False), quantised(np.split(flat, cuts[:-1]))


def _digits(values: np.ndarray) -> list[str]:
    """Scores as text: they may not fit in a long."""
    return [str(int(x)) for x in values]


def _numbers(texts: list[str]) -> np.ndarray:
    values = [int(x) for x in texts]
    fits = all(-(1 << 56) < x < 1 << 56 for x in values)  # products with the window's factors fit too
    return np.array(values, dtype=np.int64) if fits else np.array([*values, None], dtype=object)[:-1]


def _heap_rows(heaps: dict, names: list[str]) -> Iterator[pa.RecordBatch]:
    """One row per heap: its key, scores and ids."""
    if not heaps:
        return
    keys = [[k] if len(names) == 1 else list(k) for k in heaps]
    columns = [pa.array([int(k[i]) for k in keys], pa.int64()) for i in range(len(names))]
    yield pa.RecordBatch.from_arrays([*columns, pa.array([_digits(s) for s, _ in heaps.values()], pa.list_(pa.string())),
                                      pa.array([i.tolist() for _, i in heaps.values()], pa.list_(pa.int64()))], [*names, "scores", "ids"])


def _merged(heaps: DataFrame, names: list[str], size: int) -> DataFrame:
    """Heaps of equal keys merged to one; a group holds one small heap per task."""

    def merge(key: tuple, part: pa.Table) -> pa.Table:
        scores = _numbers([x for row in part.column("scores").to_pylist() for x in row])
        ids = np.array([x for row in part.column("ids").to_pylist() for x in row], dtype=np.int64)
        scores, ids = best(scores, ids, size)
        fixed = [pa.array([k.as_py()], pa.int64()) for k in key]
        return pa.table([*fixed, pa.array([_digits(scores)], pa.list_(pa.string())), pa.array([ids.tolist()], pa.list_(pa.int64()))],
                        [*names, "scores", "ids"])

    return heaps.groupBy(*names).applyInArrow(merge, heaps.schema)


def usable(rows: DataFrame, label: Column | str = "label") -> DataFrame:
    """id, tag, vector of the rows that take part. ``label``: the label that rows are mined with."""
    finite = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    tag = F.col(label) if isinstance(label, str) else label
    return (rows.select(F.col("vec_id").cast("long").alias("id"), tag.cast("long").alias("tag"),
                        F.col("embedding").cast("array<double>").alias("vector"))
            .where("id is not null and tag is not null and vector is not null").where(finite))


def _blocks(anchors: DataFrame, block_bytes: int) -> Iterator[list]:
    """Anchors in blocks of bounded size; the driver holds one block at a time."""
    held, own = 0, []
    for row in anchors.toLocalIterator():
        own.append((row["id"], row["tag"], row["vector"]))
        held += 8 * len(row["vector"]) + 64
        if held >= block_bytes:
            yield own
            held, own = 0, []
    if own:
        yield own


def mine(rows: DataFrame, anchors: DataFrame, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW,
         high: int = HIGH, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``, ``anchors``: id, tag, vector as :func:`usable` gives them. Every anchor's positives are its first
    ``positives`` other rows of its label; each positive gets the first ``negatives`` rows of other
    labels with low * positive_score <= 100 * negative_score <= high * positive_score."""
    spark = rows.sparkSession
    scratch = Scratch(spark, "hard-negatives")
    context = spark.sparkContext
    single = anchors.groupBy("id").agg(F.min(F.struct("tag", "vector")).alias("x")).select("id", "x.tag", "x.vector")

    def positives_of(block: list) -> list:
        by_tag: dict[int, list[int]] = {}
        for i, (_, tag, _) in enumerate(block):
            by_tag.setdefault(tag, []).append(i)
        sides = {t: (np.array([block[i][0] for i in own]), quantised([block[i][2] for i in own])) for t, own in by_tag.items()}
        shared = context.broadcast(sides)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            heaps: dict = {}
            for batch in batches:
                for ids, tags, vectors in _tiles(batch, sum(len(x) for x, _ in shared.value.values())):
                    for tag, (own, matrix) in shared.value.items():
                        mine_ = np.flatnonzero(tags == tag)
                        if not len(mine_):
                            continue
                        scores, there = exact_scores(matrix, vectors[mine_]), ids[mine_]
                        for k, anchor in enumerate(own.tolist()):
                            other = there != anchor
                            s, i = scores[k][other], there[other]
                            # one place more per repeated pair is kept by the tie rule of _pruned
                            take = _pruned(s, positives) if len(np.unique(i)) == len(i) else np.arange(len(i))
                            _push(heaps, anchor, s[take], i[take], positives)
            yield from _heap_rows(heaps, ["anchor"])

        heaps = rows.mapInArrow(run, "anchor long, scores array<string>, ids array<long>")
        return _merged(heaps, ["anchor"], positives).collect()  # at most `positives` pairs per anchor of one block

    def negatives_of(block: list, found: list, number: int) -> DataFrame:
        chosen = {r["anchor"]: (r["ids"], r["scores"]) for r in found}
        own = [x for x in block if x[0] in chosen]
        side = (np.array([x[0] for x in own]), np.array([x[1] for x in own]), quantised([x[2] for x in own]))
        shared = context.broadcast((side, chosen))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            (anchor_ids, anchor_tags, matrix), positive = shared.value
            heaps: dict = {}
            for batch in batches:
                for ids, tags, vectors in _tiles(batch, len(anchor_ids)):
                    scores = exact_scores(matrix, vectors)
                    for k, anchor in enumerate(anchor_ids.tolist()):
                        differ = np.flatnonzero((tags != anchor_tags[k]) & (ids != anchor))
                        s, i = scores[k][differ], ids[differ]
                        plain = len(np.unique(i)) == len(i)
                        for other, p in zip(positive[anchor][0], map(int, positive[anchor][1]), strict=True):
                            # 100 * s between the bounds, as bounds of s itself
                            least, most = -(-low * p // 100), high * p // 100
                            inside = np.flatnonzero((s >= least) & (s <= most))
                            take = inside[_pruned(s[inside], negatives)] if plain else inside
                            _push(heaps, (anchor, other), s[take], i[take], negatives)
            yield from _heap_rows(heaps, ["anchor", "positive"])

        heaps = rows.mapInArrow(run, "anchor long, positive long, scores array<string>, ids array<long>")
        merged = _merged(heaps, ["anchor", "positive"], negatives)
        known = spark.createDataFrame([(a, p, s) for a, (ids, scores) in chosen.items() for p, s in zip(ids, scores, strict=True)],
                                      "anchor long, positive long, score string")
        return scratch.save(merged.join(known, ["anchor", "positive"]), f"block-{number}")

    def in_range(digits: Column) -> Column:
        wide = digits.try_cast("decimal(38,0)")
        end = F.when(digits.startswith("-"), F.lit(-(1 << 63))).otherwise(F.lit((1 << 63) - 1))
        return F.when(wide.between(F.lit(-(1 << 63)), F.lit((1 << 63) - 1)), wide.cast("long")).otherwise(end)

    done = [negatives_of(block, positives_of(block), n) for n, block in enumerate(_blocks(single, block_bytes))]
    if not done:
        return spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    return (reduce(DataFrame.union, done)
            .select("anchor", "positive", "score", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "x"))
            .select(F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), (F.col("at") + 1).cast("int").alias("rank"),
                    F.col("x.ids").alias("negative_id"), in_range(F.col("score")).alias("positive_score"),
                    in_range(F.col("x.scores")).alias("negative_score")))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Anchors: rows whose vec_id is divisible by 100, against all rows; where vec_id is divisible by 7
    the label is first moved by one."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    rows = usable(table(spark, sf_dir, "embeddings"), moved)
    return mine(rows, rows.where("id % 100 = 0"))


OP12_SQL = """
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS tag,
         list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other_id, a.tag = b.tag AS same,
         CAST(coalesce(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])), 0) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
positives AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
negatives AS (
  SELECT anchor_id, positive_id, positive_score, other_id AS negative_id, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id) AS rank
  FROM positives JOIN scores USING (anchor_id)
  WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE rank <= 10
"""
