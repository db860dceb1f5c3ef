import hashlib
import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from veritab.operators import evaluate as EV
from veritab.operators import pairs as P


def test_hashes_of_many_rows_are_md5():
    keys = [b"", b"a|", b"x" * 55, b"y" * 56, b"z" * 200, *[b"%d|%d|" % (i * 7919, i % 5) for i in range(3_000)]]
    part = pa.table({"_key": pa.array(keys, pa.binary()), "at": pa.array(range(len(keys)))})
    packed = pa.Table.from_batches([P._pack_rows(part), P._pack_rows(part.slice(3, 700))])  # two that were packed by themselves
    at = P._rows_of(packed, "at").to_pylist()
    assert packed.num_rows == sum(-(-n // P.PACKED) for n in (len(keys), 700)) and sorted(at[:len(keys)]) == list(range(len(keys)))
    rows = P._Keys(packed)
    for tail in (b"feature|9|42", b"longer feature|10|42", b"42", b"", b"f" * 60, b"u|0|1"):
        want = b"".join(hashlib.md5(keys[i] + tail).digest() for i in at)
        assert np.array_equal(rows.hashed(tail), np.frombuffer(want, ">u8").reshape(-1, 2))


@pytest.mark.parametrize("h", [[5], [7, 7, 7, 3], [0, (1 << 64) - 1, 1, 1 << 63]])
def test_order_is_that_of_all_bits_then_values(h):
    h = np.array(h * 3, dtype=np.uint64)
    v = np.arange(len(h))[::-1]
    assert P._ordered(h, v).tolist() == np.lexsort((v, h)).tolist()
    many = np.random.default_rng(3).integers(0, 1 << 12, 5_000, dtype=np.uint64) + np.uint64(1 << 63)
    assert np.array_equal(many[P._ordered(many)], np.sort(many))


def test_pieces_follow_the_pairs_not_their_square(spark, monkeypatch):
    """A job has a range per BLOCK_VALUES rows; before, it had one per block of receivers of all jobs."""
    df = spark.range(400).select("id", (F.col("id") % 7).cast("double").alias("u"), (F.col("id") / 3).alias("v"))
    whole = sorted(map(tuple, P.permutation_pairs(df, ["u", "v"], ["id"], 6).collect()))
    made, keep = [], P.run_table

    def held(frame):
        made.append(keep(frame))
        return made[-1]

    monkeypatch.setattr(P, "run_table", held)
    monkeypatch.setattr(P, "BLOCK_VALUES", 100)
    assert sorted(map(tuple, P.permutation_pairs(df, ["u", "v"], ["id"], 6).collect())) == whole
    assert sum(x.count() for x in made if "vals" in x.columns) <= 12 * 4


def _from_pairs(df, weights, bias, key, repeats):
    """The importance from the rows of the pairs, scored by Spark."""
    z = sum((F.col(c) * w for c, w in weights.items()), F.lit(bias))
    pairs = EV.permutation_pairs(df.withColumn("_z", z), list(weights), key, repeats, 42, ["label", "_z"])
    w = F.create_map(*[x for f, v in weights.items() for x in (F.lit(f), F.lit(v))])
    score = lambda x: (F.round(F.lit(1.0) / (F.lit(1.0) + F.exp(-x)), 9) >= 0.5).cast("int")
    scored = pairs.withColumn("p", score(F.col("_z") + w[F.col("feature")] * (F.col("permuted") - F.col("original"))))
    base = EV.classification_metrics(df.withColumn("p", score(z)), "label", "p").first().recall
    drops = {}
    for r in EV.classification_metrics(scored, "label", "p", ["feature", "repeat"]).collect():
        drops.setdefault(r.feature, []).append(base - r.recall)
    return {f: (np.mean(d), np.std(d)) for f, d in drops.items()}


def test_importance_from_cells_of_blocks_equals_that_of_all_pairs(spark, monkeypatch):
    r = np.random.default_rng(8)
    rows = [(i, float(u), float(v), int(u - v + e > 0)) for i, (u, v, e) in enumerate(r.normal(size=(300, 3)))]
    rows += [(None, 1.0, 2.0, 1), (5, 3.0, -1.0, 0), (5, -3.0, 1.0, 1), (900, None, 1.0, 1), (901, 1.0, math.nan, 1), (902, 1.0, 1.0, None), (903, 2.0, 2.0, 2),
             (904, math.inf, 0.0, 1)]
    df = spark.createDataFrame(rows, "id long, u double, v double, label int").repartition(3)
    want = _from_pairs(df, {"u": 1.5, "v": -1.0}, 0.25, ["id"], 3)
    monkeypatch.setattr(P, "BLOCK_VALUES", 500)
    got = {x.feature: (x.importance_mean, x.importance_std) for x in EV.linear_permutation_importance(df, {"u": 1.5, "v": -1.0}, 0.25, "label", ["id"], 3).collect()}
    assert set(got) == {"u", "v"} and all(np.allclose(got[f], want[f], atol=1e-12) for f in got)
    cells = P.permuted_cells(df, {"u": 1.5, "v": -1.0}, F.col("u") * 1.5 - F.col("v") + 0.25, F.col("label"), ["id"], 3)
    assert cells.where("feature IS NOT NULL").count() <= 2 * 3 * 4 * -(-len(rows) * 6 // 500)  # not a row per pair


def test_no_rows_no_importance(spark):
    none = spark.createDataFrame([], "id long, u double, label int")
    assert EV.linear_permutation_importance(none, {"u": 1.0}, 0.0, "label", ["id"], 2).count() == 0
    keyless = spark.createDataFrame([(None, 1.0, 1), (None, 2.0, 0)], "id long, u double, label int")
    assert EV.linear_permutation_importance(keyless, {"u": 1.0}, 0.0, "label", ["id"], 2).count() == 0
