"""Operator 6: document quality by Bradley-Terry pairwise ranking.

A document's strength is a linear function of features of its whole text. The chance that
document i is preferred to j is the logistic function of the difference of their strengths; the
weights are fitted by logistic loss on feature differences of preference pairs (a document marked
good against one marked bad). The strength at the quantile that equals the share of bad documents
among the labelled ones is the threshold: its score is ``THRESHOLD``, and the score rises with the
strength.

All labelled documents that are not held out are learnt. Their features are written once, in blocks of about
``BLOCK`` documents by a hash of their id; in a block every good document is preferred to every bad one. Documents of a rare
label are copied to further blocks, so that each block has about ``RARE`` of them or all. A Newton step is one scan
of the blocks, of which sums reach the driver; the threshold is found by counts in narrowing ranges. labels, lang, source and
doc_id are never inputs of a score. Features are made per row in vectorised pieces of bounded size:
no shuffle. Null or empty texts score 0; null labels are not learnt, of several labels for one
document the largest counts; without both labels every text scores 0.5; repeated rows are scored
each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import Scratch, fresh, shuffle_width, table
from .words import PIECE, shingle_hashes, text_buffers, word_hashes

#: Labelled documents of a block, those of the rarer label in it, steps and penalty of the fit, score at the threshold.
BLOCK, RARE, STEPS, PENALTY, THRESHOLD = 500, 50, 40, 1e-3, 0.7
#: Sums are whole multiples of these, so they do not depend on the order of tasks; parts in which they are added up;
#: numbers the driver takes to find a quantile.
SUM_UNIT, MOMENT_UNIT, PARTS, FEW = 2.0 ** -24, 2.0 ** -16, 16, 10_000
#: Kinds of bytes whose runs of three are counted, and rows handled at once.
KINDS, ROWS = 8, 1_000

_DENSE = 12
WIDTH = KINDS ** 3 + _DENSE


def _kinds() -> np.ndarray:
    """0 lower case and other letters, 1 upper case, 2 digit, 3 blank, 4 line end, 5 prose
    punctuation, 6 exclamation and question marks, 7 other signs."""
    kind = np.full(256, 7, dtype=np.int64)
    kind[128:] = 0
    kind[ord("a"):ord("z") + 1] = 0
    kind[ord("A"):ord("Z") + 1] = 1
    kind[ord("0"):ord("9") + 1] = 2
    kind[[9, 11, 12, 32]] = 3
    kind[[10, 13]] = 4
    kind[[ord(c) for c in ".,;:'\"-()"]] = 5
    kind[[ord(c) for c in "!?"]] = 6
    return kind


def _distinct_share(values: np.ndarray) -> tuple[float, float]:
    """(share of distinct values, share of the most frequent one)."""
    if not len(values):
        return 1.0, 0.0
    _, n = np.unique(values, return_counts=True)
    return len(n) / len(values), n.max() / len(values)


def _line_hashes(data: np.ndarray) -> np.ndarray:
    lines = data.tobytes().split(b"\n")
    return np.array([hash(x.strip()) for x in lines if x.strip()], dtype=np.int64)


def features(column: pa.Array) -> np.ndarray:
    """Row x feature of whole texts; empty texts are all 0."""
    body, offsets = text_buffers(column)
    kinds, out = _kinds(), np.zeros((len(column), WIDTH), dtype=np.float32)
    a = 0
    while a < len(column):
        b = int(np.searchsorted(offsets, offsets[a] + PIECE, "right")) - 1
        b = min(max(b, a + 1), a + ROWS, len(column))
        rows = offsets[a:b + 1] - offsets[a]
        data = body[offsets[a]:offsets[b]]
        runs = np.zeros((b - a) * KINDS ** 3)
        for at in range(0, max(len(data) - 2, 0), PIECE):  # one long text takes several steps
            part = kinds[data[at:at + PIECE + 2]]
            code = (part[:-2] * KINDS + part[1:-1]) * KINDS + part[2:]
            place = np.arange(at, at + len(code))
            row = np.searchsorted(rows, place, "right") - 1
            inside = place + 2 < rows[row + 1]
            runs += np.bincount((row * KINDS ** 3 + code)[inside], minlength=len(runs))
        runs = runs.reshape(b - a, KINDS ** 3)
        out[a:b, :KINDS ** 3] = np.sqrt(runs / np.maximum(runs.sum(axis=1, keepdims=True), 1))
        words, counts = word_hashes(body, offsets[a:b + 1])
        shingles, owner = shingle_hashes(words, counts, 3)
        word_cuts, cuts = np.cumsum([0, *counts]), np.searchsorted(owner, np.arange(b - a + 1))
        for i in range(b - a):
            own, size = words[word_cuts[i]:word_cuts[i + 1]], int(rows[i + 1] - rows[i])
            if not size:
                continue
            lines = _line_hashes(data[rows[i]:rows[i + 1]])
            variety, top = _distinct_share(own)
            phrases, top_phrase = _distinct_share(shingles[cuts[i]:cuts[i + 1]])
            line_variety, top_line = _distinct_share(lines)
            near = float(np.mean(own[1:] == own[:-1])) if len(own) > 1 else 0.0
            out[a + i, KINDS ** 3:] = [1.0, np.log1p(size), np.log1p(len(own)), size / max(len(own), 1) / 10, variety,
                                       variety * np.log1p(len(own)), top, phrases, top_phrase, line_variety, top_line, near]
        a = b
    return out


@dataclass
class Ranking:
    """Weights over standardised features; scores put ``cut`` at THRESHOLD."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    cut: float = 0.0

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8)

    def strength(self, x: np.ndarray) -> np.ndarray:
        return self.standard(x) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        odds = np.log(THRESHOLD / (1 - THRESHOLD))
        return 1 / (1 + np.exp(-np.clip(self.strength(x) - self.cut + odds, -40, 40)))


def _pull(z: np.ndarray, good: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Loss, pairs, gradient and upper Hessian of all pairs of a good and a bad row, in units of SUM_UNIT."""
    width = z.shape[1]
    if good.all() or not good.any():
        return np.zeros(2 + width + width * (width + 1) // 2, dtype=np.int64)
    i, j = z[good], z[~good]
    ahead = (i @ weights)[:, None] - (j @ weights)[None, :]
    wrong = 1 / (1 + np.exp(np.clip(ahead, -40, 40)))  # chance of the wrong order
    grad = wrong.sum(axis=0) @ j - wrong.sum(axis=1) @ i
    bend = wrong * (1 - wrong)
    cross = i.T @ (bend @ j)
    hess = (i.T * bend.sum(axis=1)) @ i + (j.T * bend.sum(axis=0)) @ j - cross - cross.T
    parts = [[np.logaddexp(0, -ahead).sum(), ahead.size], grad, hess[np.triu_indices(width)]]
    return np.rint(np.concatenate(parts) / SUM_UNIT).astype(np.int64)


def _moments(x: np.ndarray, good: np.ndarray) -> np.ndarray:
    """Rows, good rows, sums and sums of squares, in units of MOMENT_UNIT."""
    x = np.clip(x.astype(np.float64), -1e4, 1e4)
    parts = [[len(x), good.sum()], x.sum(axis=0), (x * x).sum(axis=0)]
    return np.rint(np.concatenate(parts) / MOMENT_UNIT).astype(np.int64)


def _standard(sums: np.ndarray) -> Ranking:
    width = len(sums) // 2 - 1
    mean, square = (x * MOMENT_UNIT / (sums[0] * MOMENT_UNIT) for x in (sums[2:2 + width], sums[2 + width:]))
    return Ranking(mean, np.maximum(np.sqrt(np.maximum(square - mean ** 2, 0)), 1e-3), np.zeros(width))


def _descend(model: Ranking, sums_at: Callable[[np.ndarray], np.ndarray], steps: int = STEPS, penalty: float = PENALTY) -> None:
    """Newton steps, halved while the loss rises, on the mean loss of the pairs whose sums ``sums_at`` gives."""
    width = len(model.weights)
    upper = np.triu_indices(width)

    def at(weights: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        sums = sums_at(weights) * SUM_UNIT
        pairs, hess = max(sums[1], 1), np.zeros((width, width))
        hess[upper] = sums[2 + width:] / pairs
        hess = hess + np.triu(hess, 1).T + penalty * np.eye(width)
        return sums[0] / pairs + penalty / 2 * float(weights @ weights), sums[2:2 + width] / pairs + penalty * weights, hess

    loss, grad, hess = at(model.weights)
    move = np.linalg.solve(hess, grad)
    for _ in range(steps):
        if grad @ move < 1e-7:
            break
        weights = model.weights - move
        new = at(weights)
        if new[0] > loss:
            move = move / 2
            continue
        model.weights, (loss, grad, hess) = weights, new
        move = np.linalg.solve(hess, grad)


def fit_ranking(x: np.ndarray, good: np.ndarray, share_bad: float) -> Ranking:
    """The ranking of rows in memory, by all their pairs."""
    model = _standard(_moments(x, good))
    z = model.standard(x)
    _descend(model, lambda weights: _pull(z, good, weights))
    strength = z @ model.weights
    order = np.argsort(strength)
    weight = np.where(good, (1 - share_bad) / good.sum(), share_bad / (~good).sum())[order]
    at = int(np.clip(np.searchsorted(np.cumsum(weight), share_bad - 1e-9), 0, len(order) - 2))
    model.cut = float((strength[order[at]] + strength[order[at + 1]]) / 2)
    return model


def held_out(doc_id: str = "doc_id") -> F.Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")), F.lit(0)) % 4 == 2


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(features, good, not a copy) of every block; of repeated documents the first row."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("block", "doc_id", "quality", "copy", "x")), strict=True):
            if held and row[0] != held[-1][0]:
                yield _unpacked(held)
                held = []
            if not held or row[1] != held[-1][1]:
                held.append(row)
    if held:
        yield _unpacked(held)


def _unpacked(held: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return (np.stack([np.frombuffer(r[4], np.float32) for r in held]), np.array([r[2] == 1 for r in held], dtype=bool),
            np.array([r[3] == 0 for r in held], dtype=bool))


def _added(rows: DataFrame, sums: Callable[..., np.ndarray]) -> np.ndarray:
    """``sums`` of every block, added up in PARTS parts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for block in _blocks(batches):
            found = sums(*block)
            total = found if total is None else total + found
        if total is not None:
            parts = [x.tobytes() for x in np.array_split(total, PARTS)]
            yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array(parts, pa.binary())], ["part", "sums"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.int64) for x in group.column("sums").to_pylist())
        return pa.table({"part": group.column("part").slice(0, 1), "sums": pa.array([total.tobytes()], pa.binary())})

    kind = "part int, sums binary"
    found = sorted(rows.mapInArrow(run, kind).groupBy("part").applyInArrow(add, kind).collect())
    return np.concatenate([np.frombuffer(r["sums"], np.int64) for r in found]) if found else np.zeros(0, np.int64)


def _ranked(values: DataFrame, rank: int) -> float:
    """The value with ``rank`` smaller ones before it, from counts in ranges that narrow."""
    left, low, high = values.agg(F.count("s"), F.min("s"), F.max("s")).first()
    while left > FEW and low < high:
        width = (high - low) / 1_000
        cells = sorted(values.where(F.col("s").between(low, high)).groupBy(F.floor((F.col("s") - low) / width).alias("c"))
                       .agg(F.count("s").alias("n"), F.min("s").alias("a"), F.max("s").alias("z")).collect())
        for _, left, low, high in cells:
            if rank < left:
                break
            rank -= left
    if low == high:
        return low
    return sorted(r["s"] for r in values.where(F.col("s").between(low, high)).collect())[rank]


def train(docs: DataFrame, labels: DataFrame) -> Ranking | None:
    """The fitted ranking, or None without documents of both labels; other labels than 0 and 1 teach nothing."""
    scratch = Scratch(docs.sparkSession, "quality")
    marked = (labels.where("quality in (0, 1) and doc_id is not null").where(~held_out())
              .groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")))
    sizes = {r["quality"]: r["count"] for r in marked.groupBy("quality").count().collect()}  # two rows
    if set(sizes) != {0, 1}:
        return None
    blocks, rare = -(-sum(sizes.values()) // BLOCK), min(sizes, key=lambda q: sizes[q])
    copies = min(blocks, -(-RARE * blocks // sizes[rare]))
    places = F.sequence(F.lit(0), F.when(F.col("quality") == rare, copies - 1).otherwise(0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [x.tobytes() for x in features(batch.column("text"))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("quality"), pa.array(rows, pa.binary())],
                                             ["doc_id", "quality", "x"])

    # by a shuffle at every size: labels are not bounded, so a broadcast would end somewhere
    found = (docs.select("doc_id", "text").hint("merge").join(marked, "doc_id").select("doc_id", "quality", "text")
             .mapInArrow(run, "doc_id long, quality int, x binary")
             .select("doc_id", "quality", "x", F.explode(places).alias("copy"))
             .withColumn("block", F.pmod(F.xxhash64("doc_id", F.lit("quality")) + F.col("copy"), F.lit(blocks))))
    # a block lies in one task, in the order of ids
    rows = scratch.save(found.repartition(min(blocks, shuffle_width(docs.sparkSession)), "block")
                        .sortWithinPartitions("block", "doc_id", "x"), "features")
    sums = _added(rows, lambda x, good, own: _moments(x[own], good[own]))
    n, n_good = (int(round(v * MOMENT_UNIT)) for v in sums[:2]) if len(sums) else (0, 0)
    if not 0 < n_good < n:
        return None
    model = _standard(sums)
    mean, scale = model.mean, model.scale
    _descend(model, lambda weights: _added(rows, lambda x, good, _: _pull(Ranking(mean, scale, weights).standard(x), good, weights)))

    def strengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for x, _, own in _blocks(batches):
            yield pa.RecordBatch.from_arrays([pa.array(model.strength(x[own]))], ["s"])

    values, at = scratch.save(rows.mapInArrow(strengths, "s double"), "strengths"), min(n - n_good - 1, n - 2)
    model.cut = (_ranked(values, at) + _ranked(values, at + 1)) / 2
    scratch.drop("features", "strengths")
    return model


def score_quality(docs: DataFrame, model: Ranking | None, keep: list[str], name: str = "quality_score") -> DataFrame:
    """The columns ``keep`` and the score, named ``name`` (not one of ``keep``), of every row; the model (WIDTH
    weights) goes with the task."""
    text = fresh("quality_text", keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = features(batch.column(text))
            score = np.full(len(x), 0.5) if model is None else model.score(x)
            score[~x.any(axis=1)] = 0.0
            yield pa.RecordBatch.from_arrays([batch.column(c) for c in keep] + [pa.array(score.astype(float))], [*keep, name])

    fields = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    return docs.select(*[F.col(f"`{c}`") for c in keep], F.col("text").alias(text)).mapInArrow(run, f"{fields}, `{name}` double")


def op6_quality_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = score_quality(docs, train(docs, table(spark, sf_dir, "labels")), ["doc_id"])
    return scored.select("doc_id", held_out().alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= THRESHOLD).cast("int").alias("predicted"))
